"""Sharding by a hypergeometric communication matrix (native).

A uniform shuffle with exact shard sizes, without a global sort: rows fall into
blocks by a hash of their id and content; how many of each block go to each cell of a
shard is drawn exactly, from the multivariate hypergeometric distribution; a block
permutes its rows and deals them out by these counts; a cell permutes what it received.
Cells have known sizes, hence known first slots, and no shard is sorted as a whole.
Whole rows move twice: into blocks, and from blocks to cells.

The matrix is drawn down a binary tree of blocks: the rows that a node's left half
holds are split over the cells, and both halves go on. Blocks and cells grow with the
rows, up to MOST_BLOCKS each; the matrix is a table with a row per block, which Spark
broadcasts as long as its size allows and else joins where the blocks are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventloom.functions.scratch import staged

SHARDS = 16
BLOCK_ROWS, LEAST_BLOCKS, MOST_BLOCKS = 1 << 14, 64, 4096
#: Copies of one row that share a block; the next ones go to other blocks.
COPIES = 1 << 12
#: Half-width, in standard deviations, of the counts a draw considers; what lies
#: outside has less weight than the rounding of a double.
REACH = 12


def cell_sizes(rows: int, shards: int, per_shard: int) -> list[int]:
    """Sizes of all cells, shard by shard: shards differ by at most one row."""
    sizes = []
    for shard in range(shards):
        of_shard = rows // shards + (shard < rows % shards)
        sizes += [of_shard // per_shard + (c < of_shard % per_shard) for c in range(per_shard)]
    return sizes


def hypergeometric(good: str, all_: str, draws: str, u: str, name: str) -> str:
    """SQL that draws how many of ``draws`` rows out of ``all_`` are among ``good``.

    By inversion: the weights of the possible counts around the mean follow each other
    by their ratio; the count is where their running sum passes ``u`` of the total.
    ``name`` tells the lambdas of nested uses apart.
    """
    v = f"v_{name}"
    parameters = f"""transform(array(struct({good} AS g, {all_} AS n, {draws} AS d, {u} AS u)), {v} ->
        struct({v}.g AS g, {v}.n AS n, {v}.d AS d, {v}.u AS u, {v}.d * {v}.g / {v}.n AS mean,
          {REACH} + {REACH} * sqrt({v}.d * {v}.g / {v}.n * (1 - {v}.g / {v}.n)
                                   * ({v}.n - {v}.d) / greatest({v}.n - 1, 1)) AS reach))"""
    bounds = f"""transform({parameters}, {v} -> struct({v}.g AS g, {v}.n AS n, {v}.d AS d, {v}.u AS u,
        greatest(0, {v}.d - ({v}.n - {v}.g), bigint(floor({v}.mean - {v}.reach))) AS low,
        least({v}.d, {v}.g, bigint(ceil({v}.mean + {v}.reach))) AS high))"""
    ratio = f"(double({v}.g - k) * ({v}.d - k) / ((k + 1D) * ({v}.n - {v}.g - {v}.d + k + 1)))"
    total = f"""aggregate(sequence({v}.low, {v}.high), struct(1D AS w, 0D AS s),
        (a, k) -> struct(a.w * {ratio} AS w, a.s + a.w AS s), a -> a.s)"""
    passed = f"""aggregate(sequence({v}.low, {v}.high), struct(1D AS w, 0D AS s, 0L AS c),
        (a, k) -> struct(a.w * {ratio} AS w, a.s + a.w AS s,
                         a.c + if(a.s + a.w <= {v}.u * {v}.total, 1L, 0L) AS c), a -> a.c)"""
    summed = f"""transform({bounds}, {v} -> struct({v}.g AS g, {v}.n AS n, {v}.d AS d, {v}.u AS u,
        {v}.low AS low, {v}.high AS high, {total} AS total))"""
    drawn = f"transform({summed}, {v} -> least({v}.high, {v}.low + {passed}))[0]"
    return f"if(({good}) = 0 OR ({draws}) = 0, 0L, {drawn})"


def split_node(cells: int, seed: int) -> Column:
    """Of a node's cell sizes ``room``, what its left half's ``left`` rows fill."""
    u = f"""(shiftrightunsigned(xxhash64({seed}L, depth, node, j), 11) + 0.5D) / {1 << 53}D"""
    draw = hypergeometric("room[j]", "s.n", "s.d", u, "x")
    return F.expr(
        f"""aggregate(sequence(0, {cells - 1}),
            struct(left_rows AS d, rows AS n, cast(array() AS array<bigint>) AS taken),
            (s, j) -> aggregate(array({draw}), s, (t, x) ->
              struct(t.d - x AS d, t.n - room[j] AS n, concat(t.taken, array(x)) AS taken)),
            s -> s.taken)"""
    )


def communication_matrix(counts: DataFrame, blocks: int, sizes: list[int], seed: int) -> DataFrame:
    """Per block, the running totals of what it sends to each cell: block, ends.

    ``counts`` has block and n. ``blocks`` must be a power of two.
    """
    spark = counts.sparkSession
    root = (
        spark.range(blocks)
        .join(counts, F.col("id") == F.col("block"), "left")
        .agg(F.sort_array(F.collect_list(F.struct("id", F.coalesce("n", F.lit(0)).alias("n")))).alias("c"))
        .select(
            F.lit(0).alias("depth"),
            F.lit(0).cast("long").alias("node"),
            F.transform("c", lambda c: c["n"]).alias("counts"),
            F.from_json(F.lit(str(sizes)), "array<bigint>").alias("room"),
        )
    )
    nodes, width = root, blocks
    while width > 1:
        width //= 2
        total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda x, y: x + y)
        nodes = nodes.withColumns(
            {"left_rows": total(F.slice("counts", 1, width)), "rows": total("counts")}
        ).withColumn("taken", split_node(len(sizes), seed))
        left = F.struct(
            (F.col("node") * 2).alias("node"), F.slice("counts", 1, width).alias("counts"), F.col("taken").alias("room")
        )
        right = F.struct(
            (F.col("node") * 2 + 1).alias("node"),
            F.slice("counts", width + 1, width).alias("counts"),
            F.zip_with("room", "taken", lambda r, t: r - t).alias("room"),
        )
        nodes = nodes.select((F.col("depth") + 1).alias("depth"), F.explode(F.array(left, right)).alias("n")).select(
            "depth", "n.*"
        )
        if blocks // width in (16, 256):  # deep levels have many nodes
            nodes = nodes.repartition(blocks // width, "node")
    running = F.expr("transform(sequence(1, size(room)), i -> aggregate(slice(room, 1, i), 0L, (a, b) -> a + b))")
    return nodes.select(F.col("node").alias("block"), running.alias("ends"))


def ends_before(place: str, cells: int) -> Column:
    """How many of the running totals ``ends`` are less than ``place``, by halving."""
    middle = "int((s.low + s.high) div 2)"
    return F.expr(
        f"""aggregate(sequence(1, {cells.bit_length()}), struct(0 AS low, {cells} AS high),
            (s, i) -> CASE WHEN s.low >= s.high THEN s
                           WHEN ends[{middle}] < {place} THEN struct({middle} + 1 AS low, s.high AS high)
                           ELSE struct(s.low AS low, {middle} AS high) END,
            s -> s.low)"""
    )


def in_chunks(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` (row, key, content) with ``chunk``, and how many there are: key, content, chunk, n.

    The chunk is 0 but for copies of one row beyond COPIES. Such rows are counted and
    reduced to one on the map side and written out again chunk by chunk, so no task
    meets all of them.
    """
    names = ("key", "content")
    same = F.col("key").eqNullSafe(F.col("hot_key")) & (F.col("content") == F.col("hot_content"))
    hot = staged(
        rows.groupBy(*names).agg(F.count("*").alias("copies")).where(F.col("copies") > COPIES)
        .select(F.col("key").alias("hot_key"), F.col("content").alias("hot_content"), "copies"),
        "hot-rows",
    )
    first = F.lit(0).cast("long").alias("chunk")
    if not hot.take(1):
        return rows.select("*", first), rows.select(*names, first, F.lit(1).cast("long").alias("n"))
    others = rows.join(hot, same, "left_anti").select("row", *names, first)
    chunks = hot.withColumn("chunk", F.explode(F.sequence(first, F.floor((F.col("copies") - 1) / COPIES)))).withColumn(
        "n", F.least(F.lit(COPIES).cast("long"), F.col("copies") - F.col("chunk") * COPIES)
    )
    alone = rows.join(hot.drop("copies"), same, "left_semi").dropDuplicates([*names])
    written = (
        alone.join(chunks, same)
        .repartition(*names, "chunk")
        .select("row", *names, "chunk", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
        .drop("col")
    )
    counts = others.select(*names, "chunk", F.lit(1).cast("long").alias("n")).union(
        chunks.select(F.col("hot_key").alias("key"), F.col("hot_content").alias("content"), "chunk", "n")
    )
    return others.union(written), counts


def into_shards(rows: DataFrame, shards: int = SHARDS, seed: int = 1, key: str = "doc_id") -> DataFrame:
    """``rows`` with shard (0 up to ``shards`` - 1) and slot (gapless from 0 in a shard).

    Shard sizes differ by at most one. The place of a row follows from ``seed``, its key
    and a hash of all its columns: reruns agree, and neighbours by key or equal texts
    part. Copies of a row get places of their own. Rows are carried whole, twice; give
    the columns that are needed.

    Null keys, or one key of many rows, are spread by content; an empty table gives no
    row; columns named shard or slot are replaced, all others kept.
    """
    own = [c for c in rows.columns if c not in ("shard", "slot")]
    held = rows.select(
        F.struct(*(F.col(f"`{c}`") for c in own)).alias("row"),
        F.col(key).alias("key"),
        F.xxhash64(*(hashable(rows, c) for c in own)).alias("content"),
    )
    dealt, counted = in_chunks(held)
    drawn = F.xxhash64(F.lit(seed), "key", "content", "chunk")
    finest = staged(
        counted.groupBy(F.pmod(drawn, F.lit(MOST_BLOCKS)).alias("block")).agg(F.sum("n").alias("n")), "block-sizes"
    )
    total = finest.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    blocks = LEAST_BLOCKS
    while blocks < MOST_BLOCKS and blocks * BLOCK_ROWS < total:
        blocks *= 2
    per_shard = max(1, blocks // shards)
    sizes = cell_sizes(total, shards, per_shard)
    counts = finest.groupBy(F.pmod("block", F.lit(blocks)).alias("block")).agg(F.sum("n").alias("n"))
    matrix = staged(communication_matrix(counts, blocks, sizes, seed), "matrix")

    names = ("key", "content", "chunk")
    twin = F.row_number().over(Window.partitionBy("block", *names).orderBy("content"))
    order = (*names, "twin")
    permuted = Window.partitionBy("block").orderBy(F.xxhash64(F.lit(seed + 1), *order), *order)
    settled = Window.partitionBy("cell").orderBy(F.xxhash64(F.lit(seed + 2), *order), *order)
    placed = (
        dealt.withColumn("block", F.pmod(drawn, F.lit(blocks)))
        .repartition("block")  # serves both windows and the join
        .withColumn("twin", twin)
        .withColumn("place", F.row_number().over(permuted))
        .join(matrix, "block")
        .withColumn("cell", ends_before("place", len(sizes)))
        .drop("ends")
    )
    shard, nth = F.floor(F.col("cell") / per_shard), F.col("cell") % per_shard
    of_shard = F.lit(total // shards) + (shard < total % shards).cast("long")
    start = nth * F.floor(of_shard / per_shard) + F.least(nth, of_shard % per_shard)
    return placed.select(
        "row.*", shard.cast("int").alias("shard"), (start + F.row_number().over(settled) - 1).alias("slot")
    )


def hashable(rows: DataFrame, column: str) -> Column:
    """The column, or its text: maps and variants have no hash."""
    value, kind = F.col(f"`{column}`"), rows.schema[column].dataType.simpleString()
    return value.cast("string") if "map<" in kind or "variant" in kind else value
