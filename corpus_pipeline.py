"""The training-data pipeline: five stages over ``documents``, each one operator.

Every stage works on all that the one before it kept and returns documents with the
columns it was given; the last adds shard and slot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventloom.functions.scratch import new_path, staged
from eventloom.llm import decontaminate, language, mixing, sharding, simhash
from eventloom.llm.oracles import ORACLES
from eventloom.llm.queries import QUERIES as OPERATOR_QUERIES, table

#: Rows to leave out that are broadcast, 16 bytes each or a short name; more are joined by shuffle.
MOST_BROADCAST = 500_000


def unused(docs: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``docs`` has it."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps texts in a language, also code-switched ones; what the operator calls ``und`` goes.

    Null texts and those without a letter are ``und``. Where no row has a language to learn
    from, nothing can be judged and all rows stay. Repeated rows are judged alike.
    """
    field = language.learn(docs)
    if not field.languages:
        return docs
    predicted, score = unused(docs, "predicted"), unused(docs, "score")
    judged = language.identified(docs, field, names=(predicted, score))
    return judged.where(F.col(predicted) != language.UNDETERMINED).drop(predicted, score)


def without(docs: DataFrame, gone: DataFrame, same: Column) -> DataFrame:
    """``docs`` without the rows that ``same`` finds in the staged table ``gone``.

    A small table is broadcast, so that texts do not move; beyond that Spark shuffles.
    """
    small = gone.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST
    return docs.join(F.broadcast(gone) if small else gone, same, "left_anti")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of smallest id of each group of near-duplicates.

    Texts are told apart by more than their id, so different ones that share an id, or
    have none, are groups of their own; of repeated rows one stays. Null texts have
    fingerprint zero like all texts without words. An empty table stays empty.
    """
    mark = unused(docs, "text_mark")
    classes = simhash.near_duplicates(docs).groupBy("doc_id", "text_mark", "root").count()
    rows = staged(classes, "near-classes")
    kept = simhash.representatives_of(rows).withColumn("kept", F.lit(True))
    both = F.col("r.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("r.text_mark") == F.col("k.text_mark"))
    judged = rows.alias("r").join(kept.alias("k"), both, "left")
    named = judged.select(F.col("r.doc_id").alias("gone_id"), F.col("r.text_mark").alias("gone_mark"), "count", "kept")
    gone = staged(named.where("kept is null").select("gone_id", "gone_mark"), "near-copies")
    again = staged(named.where("kept and count > 1").select("gone_id", "gone_mark"), "repeated")

    marked = docs.withColumn(mark, simhash.text_mark(F.col("text")))
    same = marked["doc_id"].cast("long").eqNullSafe(F.col("gone_id")) & (marked[mark] == F.col("gone_mark"))
    left = without(marked, gone, same)
    if again.take(1):  # of rows that are there several times, and only of those, one is kept
        repeated = marked.join(again, same, "left_semi").dropDuplicates(["doc_id", mark])
        left = without(left, again, same).unionByName(repeated)
    return left.drop(mark)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of the benchmark, not others that share their id.

    Null and empty texts hold none; repeated rows are judged alike.
    """
    found = decontaminate.matched(docs, table(spark, sf_dir, "benchmark"))
    dirty = staged(found.where("n_hit > 0").select(F.col("row").alias("dirty_row")).distinct(), "dirty")
    return without(docs, dirty, decontaminate.row_name(docs["doc_id"], docs["text"]) == dirty["dirty_row"])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them.

    Null texts cost nothing and a null source is a source; repeated rows are drawn one by
    one. An empty table stays empty.
    """
    return mixing.mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in shards of equal size, in random order, with shard and slot.

    Rows are placed whatever they hold; repeated rows get places of their own. Columns
    named shard or slot are replaced. An empty table stays empty.
    """
    return sharding.into_shards(docs)


STAGES = [
    ("language_id", identify_languages),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]
#: Fitting, linking and drawing have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other; what each returns is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES = OPERATOR_QUERIES | {"pipeline": run}
SQL = ORACLES | ({"pipeline": ORACLE_SQL} if ORACLE_SQL else {})
