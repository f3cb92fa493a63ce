"""Mixing sources to target weights by Pareto order sampling (native).

Every document of a source is due the same expected number of copies (times its
boost): target words / words of the source. The whole part is allotted for certain.
For the rest, p, documents are ranked by random odds over inclusion odds,
Q = (u / (1 - u)) / (p / (1 - p)), and looked at in that order: one is taken if it
fits in what its source's words leave, until none that fits is left.

Sizes are summed per rank bucket, so that no source is ever sorted as a whole: only
the bucket in which a source's words run out is ranked row by row. What is left of
the words only shrinks, so documents that are larger never fit again, and the ranks
after are summed anew, in passes, over those that do. The outcome is a small table per
source, the words left after a rank, which any frame of documents can be held against.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventloom.functions.scratch import staged

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
#: Documents per rank bucket, and documents after its cutoff that a pass ranks one by one.
BUCKET_ROWS, PASS_ROWS = 1024, 64
#: Copies of one row that one row of a narrow table stands for at a time.
CHUNK = 1000
UNIFORM_BITS = 52
#: The columns that stand for one document's place in the ranking.
RANK = ("q", "doc_id", "size", "mark", "twin")
#: What rows must share to be copies of each other; ``twin`` numbers these.
IDENTITY = ("doc_id", "source", "size", "boost", "mark")


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(seed: int) -> Column:
    """A number between 0 and 1, the same in every run: 52 bits of a digest of what names a row."""
    named = (F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in ("doc_id", "mark", "twin"))
    bits = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), *named)), 1, UNIFORM_BITS // 4), 16, 10).cast("double")
    return (bits + 0.5) / float(1 << UNIFORM_BITS)


def sizes(boost: Column | None) -> list[Column]:
    """doc_id, source, size, boost and mark (a hash of the text) of a document."""
    text = F.col("text").cast("string")
    return [
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        size_of(text).alias("size"),
        F.coalesce(boost.cast("double") if boost is not None else F.lit(1.0), F.lit(0.0)).alias("boost"),
        F.xxhash64(text).alias("mark"),
    ]


def numbered_copies(documents: DataFrame) -> DataFrame:
    """The rows of ``sizes`` with ``twin``, the number of a row among its copies, from 0.

    Copies are counted on the map side and written out again in chunks, so that no task
    meets a large group of them.
    """
    counted = documents.groupBy(*IDENTITY).agg(F.count("*").alias("n"))
    chunks = counted.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / CHUNK))))
    last = F.least(F.col("n"), (F.col("chunk") + 1) * CHUNK) - 1
    each = chunks.hint("rebalance").withColumn("twin", F.explode(F.sequence(F.col("chunk") * CHUNK, last)))
    return each.select(*IDENTITY, "twin")


def targets(documents: DataFrame, weights: tuple = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """One row per source: source, source_size, boosted, target.

    ``weights`` repeat over the sources by code point, null last. A target stops at
    ``most`` times its source's words; what is over goes to the others by weight. That
    ends at one level: the sources, in order of cap over weight, are capped as long as
    theirs lies below the level that the rest would get.
    """
    sums = documents.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.sum(F.col("size") * F.col("boost")).alias("boosted")
    )
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    of_weight = F.element_at(
        F.array(*map(F.lit, weights)), (F.row_number().over(in_order) - 1) % len(weights) + 1
    )
    everything = Window.partitionBy()
    weighed = sums.select(
        "*", of_weight.cast("double").alias("weight"), (F.col("source_size") * most).alias("cap")
    ).withColumn("total", F.sum("source_size").over(everything))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    level = (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(onward)
    capped = weighed.withColumn("capped", F.col("cap") / F.col("weight") <= level)
    left = F.col("total") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(everything), F.lit(0))
    shared = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(everything)
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.col("weight") * left / shared)
    return capped.select("source", "source_size", "boosted", target.alias("target"))


def ranked(documents: DataFrame, shares: DataFrame, most: int, seed: int) -> DataFrame:
    """Documents with certain copies, p and the rank ``q`` (null where p is 0)."""
    due = F.least(
        F.lit(float(most)), F.coalesce(F.col("target") / F.nullif("boosted", F.lit(0.0)) * F.col("boost"), F.lit(0.0))
    )
    of_source = shares.withColumnRenamed("source", "of_source")
    placed = (
        documents.join(of_source, F.col("source").eqNullSafe(F.col("of_source")))
        .withColumn("due", due)
        .withColumn("certain", F.floor("due"))
        .withColumn("p", F.col("due") - F.col("certain"))
        .withColumn("u", uniform(seed))
    )
    q = (F.col("u") / (1 - F.col("u"))) * ((1 - F.col("p")) / F.col("p"))
    return placed.withColumn("q", F.when(F.col("p") > 0, q))


def cutoffs(documents: DataFrame, shares: DataFrame, most: int = MOST_COPIES, seed: int = 1) -> DataFrame:
    """``shares`` with ``room``, the words to fill, and ``steps``, what is left of them after a rank.

    A pass adds at most PASS_ROWS + 1 steps to a source. Passes end when all that still
    fits one by one also fits together; each pass takes what it can, mostly whole
    buckets, and few of many documents fit after it, so there are few passes.
    """
    rows = documents.count()
    buckets = max(1, -(-rows // BUCKET_ROWS))
    rank = F.struct(*RANK)
    all_ranked = ranked(documents, shares, most, seed)
    open_rows = staged(
        all_ranked.where("q is not null and size > 0").select(
            "source", *RANK, F.floor(F.col("q") / (1 + F.col("q")) * buckets).alias("bucket")
        ),
        "open-ranks",
    )
    words = F.sum(F.col("due") * F.col("size")) - F.sum(F.col("certain") * F.col("size"))
    wanted = staged(all_ranked.groupBy("source").agg(F.greatest(words, F.lit(0.0)).alias("room")), "rooms")
    state = wanted.select(F.col("source").alias("s"), F.col("room").alias("gap"), F.lit(None).alias("seen"))
    passes: list[DataFrame] = []
    while True:
        found = staged(one_pass(open_rows, state, rank), "steps")
        if not found.take(1):
            break
        passes.append(found)
        state = found.select("s", F.element_at("steps", -1)["left"].alias("gap"), "seen")
    ends = shares.join(wanted.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    if not passes:  # nothing runs out: every open rank is taken
        return ends.withColumn("steps", F.lit(None).cast(found.schema["steps"].dataType))
    steps = passes[0]
    for more in passes[1:]:
        steps = steps.union(more)
    steps = steps.groupBy("s").agg(F.flatten(F.collect_list("steps")).alias("steps"))
    return ends.join(steps, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")


def one_pass(open_rows: DataFrame, state: DataFrame, rank: Column) -> DataFrame:
    """For sources whose words run out: s, ``steps`` (after, left), and the last rank ``seen``.

    Only ranks after those seen are looked at, and only sizes that fit in the gap.
    """
    fits = F.col("source").eqNullSafe(F.col("s")) & (F.col("size") <= F.col("gap"))
    if dict(state.dtypes)["seen"] != "void":
        fits = fits & (rank > F.col("seen"))
    left = open_rows.join(state, fits).select("s", "gap", *RANK, "bucket")
    ascending = Window.partitionBy("s").orderBy("bucket")
    up_to = ascending.rowsBetween(Window.unboundedPreceding, 0)
    # The bucket in which the words run out, and as many more as hold PASS_ROWS rows.
    edge = (
        left.groupBy("s", "bucket")
        .agg(
            F.first("gap").alias("gap"),
            F.sum("size").alias("bucket_words"),
            F.count("*").alias("bucket_rows"),
            F.max(rank).alias("bucket_last"),
        )
        .withColumn("until", F.sum("bucket_words").over(up_to))
        .withColumn("before", F.lag("bucket_last").over(ascending))
        .where(F.col("until") > F.col("gap"))
        .withColumn("nth", F.row_number().over(ascending))
        .withColumn("rows_before", F.coalesce(F.sum("bucket_rows").over(ascending.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("first_rows", F.first("bucket_rows").over(ascending))
        .where((F.col("nth") == 1) | (F.col("rows_before") - F.col("first_rows") < PASS_ROWS))
        .select(
            F.col("s").alias("of_s"),
            F.col("bucket").alias("b"),
            F.first(F.col("until") - F.col("bucket_words")).over(ascending).alias("words_before"),
            F.first("before").over(ascending).alias("before"),
        )
    )
    by_rank = Window.partitionBy("s").orderBy(*RANK)
    near = (
        left.join(edge, F.col("s").eqNullSafe(F.col("of_s")) & (F.col("bucket") == F.col("b")))
        .withColumn("until", F.col("words_before") + F.sum("size").over(by_rank.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("taken", F.col("until") <= F.col("gap"))
        .withColumn("nth_after", F.sum(F.when(F.col("taken"), 0).otherwise(1)).over(by_rank.rowsBetween(Window.unboundedPreceding, 0)))
        .where(F.col("nth_after") <= PASS_ROWS)
        .groupBy("s")
        .agg(
            F.max(F.when(F.col("taken"), rank)).alias("last_near"),
            F.max(F.when(F.col("taken"), F.col("until"))).alias("until"),
            F.first("gap").alias("gap"),
            F.first("words_before").alias("words_before"),
            F.first("before").alias("before"),
            F.max(rank).alias("seen"),
            F.sort_array(F.collect_list(F.when(~F.col("taken"), rank))).alias("rest"),
        )
    )

    def step(after: Column, gap: Column) -> Column:
        return F.struct(after.alias("after"), gap.cast("double").alias("left"))

    def fill(steps: Column, x: Column) -> Column:
        gap = F.element_at(steps, -1)["left"]
        return F.when(x["size"] <= gap, F.concat(steps, F.array(step(x, gap - x["size"])))).otherwise(steps)

    # The first that fits is always taken, so there is a last rank taken.
    first = step(F.coalesce("last_near", "before"), F.col("gap") - F.coalesce("until", "words_before"))
    return near.select("s", F.aggregate("rest", F.array(first), fill).alias("steps"), "seen")


def allotted(documents: DataFrame, ends: DataFrame, most: int = MOST_COPIES, seed: int = 1) -> DataFrame:
    """Rows with doc_id, source, size and boost, held against ``cutoffs``: plus copies.

    ``ends`` has one row per source. It is a staged table, so Spark broadcasts it when
    its size allows and otherwise joins by shuffle, where it splits a hot source.
    """
    rank = F.struct(*RANK)
    too_large = F.exists("steps", lambda step: (step["left"] < F.col("size")) & (step["after"] < rank))
    chosen = (F.col("size") <= F.col("room")) & ~F.coalesce(too_large, F.lit(False))
    extra = F.when(F.col("q").isNotNull() & chosen, 1).otherwise(0)
    return ranked(documents, ends, most, seed).withColumn("copies", (F.col("certain") + extra).cast("int"))


def plan(docs: DataFrame, weights=WEIGHTS, most=MOST_COPIES, seed=1, boost=None) -> tuple[DataFrame, DataFrame]:
    """The documents' sizes with their copies numbered, and the cutoffs of every source; both staged."""
    documents = staged(numbered_copies(docs.select(*sizes(boost))), "sizes")
    shares = staged(targets(documents, weights, most), "targets")
    return documents, staged(cutoffs(documents, shares, most, seed), "cutoffs")


def mix(docs: DataFrame, weights=WEIGHTS, most=MOST_COPIES, seed=1, boost: Column | None = None) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target (its source's), copies.

    Reads doc_id, source, text and what ``boost`` names. ``boost`` makes documents of a
    source unequal: copies due grow in proportion to it, up to ``most``. Unless boosts
    run into ``most``, what a source's words lack to its target is less than the
    smallest of its documents that was due a further copy and did not get it.

    Null text has size 0 and so costs nothing; null source is a source, the last one;
    a null boost is 0. Rows that share an id, or have none, are drawn by their texts, and
    copies of one row one by one. An empty table gives no row. Reruns agree.
    """
    documents, ends = plan(docs, weights, most, seed, boost)
    return allotted(documents, ends, most, seed).select(
        "doc_id", "source", "size", "source_size", "target", "copies"
    )


def mixed(docs: DataFrame, weights=WEIGHTS, most=MOST_COPIES, seed=1, boost: Column | None = None) -> DataFrame:
    """The mixture itself: rows of ``docs``, left out or repeated, with their columns.

    Texts are not shuffled unless the table of cutoffs is too large to broadcast; of rows
    that are there several times, one is carried and written as often as the mixture
    takes all of them, in chunks.
    """
    documents, ends = plan(docs, weights, most, seed, boost)
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    rows = docs.select(whole, *sizes(boost), F.lit(0).cast("long").alias("twin"))
    identity = F.struct(*IDENTITY)
    again = staged(documents.where("twin = 1").select(identity.alias("copied")), "copied")
    if not again.take(1):
        return written(allotted(rows, ends, most, seed).where("copies > 0"), F.col("copies"))
    is_copy = identity == F.col("copied")
    alone = allotted(rows.join(again, is_copy, "left_anti"), ends, most, seed).where("copies > 0")
    wanted = (
        allotted(documents.join(again, is_copy, "left_semi"), ends, most, seed)
        .groupBy(identity.alias("wanted"))
        .agg(F.sum("copies").alias("n"))
        .where("n > 0")
        .withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / CHUNK))))
    )
    copied = rows.join(again, is_copy, "left_semi").select("row", identity.alias("identity")).dropDuplicates(["identity"])
    spread = copied.join(wanted, F.col("identity") == F.col("wanted")).repartition("identity", "chunk")
    return written(alone, F.col("copies")).union(written(spread, F.least(F.lit(CHUNK), F.col("n") - F.col("chunk") * CHUNK)))


def written(rows: DataFrame, times: Column) -> DataFrame:
    """The columns of ``row``, as often as ``times`` says."""
    return rows.select("row", F.explode(F.sequence(F.lit(1).cast("long"), times.cast("long")))).select("row.*")
