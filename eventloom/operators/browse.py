"""Table pages, inventories and read-only SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from eventloom.functions.counting import row_counts
from eventloom.functions.numbering import numbered
from eventloom.functions.scratch import staged

# The tables that may be browsed.
TABLES = (
    "actors",
    "repos",
    "organizations",
    "events",
    "payload_push",
    "payload_issue",
    "payload_pull_request",
    "payload_star",
    "payload_fork",
    "payload_create",
    "payload_delete",
    "payload_watch",
    "hot_repos",
    "active_developers",
    "event_stats_daily",
    "user_repo_relation",
    "repo_stats_cache",
    "actor_stats_cache",
)
SUMMARY_TABLES = (
    "hot_repos",
    "active_developers",
    "actor_stats_cache",
    "repo_stats_cache",
    "event_stats_daily",
)
MAX_ROWS = 1000
#: The most rows that a top-k may bring together in one task.
DEEP_OFFSET = 100_000


def table(tables: dict[str, DataFrame], name: str) -> DataFrame:
    """A table by name, if it is one of those that may be browsed."""
    if name not in TABLES:
        raise ValueError(f"not a browsable table: {name!r}")
    return tables[name]


def orderable(df: DataFrame, column: str) -> bool:
    kind = df.schema[column].dataType.simpleString()
    return not any(word in kind for word in ("map<", "variant", "interval"))


def around(df: DataFrame, column: str, offset: int, size: int) -> tuple[DataFrame, int]:
    """The rows whose ``column`` has a value that occurs on a page, and the number of rows before them.

    Only the values of ``column`` are counted and put in order, in range partitions.
    """
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    placed = staged(
        counts.repartitionByRange("value").sortWithinPartitions("value").withColumn("part", F.spark_partition_id()), "values"
    )
    totals = placed.groupBy("part").agg(F.sum("n").alias("total"))
    earlier = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))  # a row a partition
    before = totals.select("part", F.coalesce(earlier, F.lit(0)).alias("before"))
    so_far = F.sum("n").over(Window.partitionBy("part").orderBy("value"))
    begun = placed.join(before, "part").select("value", "n", (F.col("before") + so_far - F.col("n")).alias("start"))
    bounds = staged(
        begun.where((F.col("start") < offset + size) & (F.col("start") + F.col("n") > offset)).agg(
            F.min("value").alias("low"),
            F.max("value").alias("high"),
            F.coalesce(F.bool_or(F.col("value").isNull()), F.lit(False)).alias("nulls"),
            F.coalesce(F.min("start"), F.lit(0)).alias("start"),
        ),
        "bounds",
    )
    value = df[column]
    found = df.join(bounds, value.between(bounds["low"], bounds["high"]) | (bounds["nulls"] & value.isNull()))
    return found.select(*(df[c] for c in df.columns)), bounds.first()["start"]


def table_page(
    df: DataFrame,
    page: int = 1,
    size: int = 20,
    key: str | list[str] | None = None,
    deep: int = DEEP_OFFSET,
) -> DataFrame:
    """One page of a table in key order; without a key, in the order of its columns.

    Rows of equal key are in the order of the other columns, so pages neither
    overlap nor leave rows out. A page near the start is a top-k. For one further
    than ``deep`` rows in, or one that ends beyond ``DEEP_OFFSET``, a top-k would hold
    too many rows in one task, so the rows are numbered in parallel instead, in the same
    order; only those that share a value of the first key with the page.
    """
    given = [key] if isinstance(key, str) else list(key or ())
    keys = given + [c for c in df.columns if c not in given and orderable(df, c)]
    offset = (page - 1) * size
    if offset <= deep and offset + size <= DEEP_OFFSET:
        return df.orderBy(*keys).offset(offset).limit(size)
    near, start = around(df, keys[0], offset, size)
    places = F.col("number").between(offset - start, offset - start + size - 1)
    return numbered(near, F.lit(0), *keys).where(places).select(*df.columns).orderBy(*keys)


def page_info(df: DataFrame, page: int = 1, size: int = 20) -> DataFrame:
    """Page, size, total rows and total pages."""
    return df.agg(F.count("*").alias("total")).select(
        F.lit(page).alias("page"),
        F.lit(size).alias("page_size"),
        "total",
        F.expr(f"(total + {size - 1}) div {size}").alias("total_pages"),
    )


def table_columns(df: DataFrame, keys=()) -> DataFrame:
    """Name, type and key mark of each column."""
    rows = [(name, dtype, "PRI" if name in keys else "") for name, dtype in df.dtypes]
    return df.sparkSession.createDataFrame(rows, "field string, type string, key string")


def table_inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """All tables with their row counts, by name."""
    return row_counts(tables).orderBy("name")


def stats_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count and last update of each statistics table.

    The update time is ``stats_time`` in the daily statistics and
    ``updated_at`` elsewhere, NULL where a table has no such column.
    """
    rows = None
    for name in SUMMARY_TABLES:
        if name not in tables:
            continue
        df = tables[name]
        column = "stats_time" if name == "event_stats_daily" else "updated_at"
        updated = F.max(column) if column in df.columns else F.lit(None)
        row = df.agg(
            F.count("*").alias("row_count"), updated.cast("timestamp_ntz").alias("last_update")
        ).select(F.lit(name).alias("name"), "row_count", "last_update")
        rows = row if rows is None else rows.union(row)
    return rows


# What a query may not contain, as Spark names it in an analysed plan.
REFUSED_NODES = {"ScriptTransformation"}
REFUSED_FUNCTIONS = {"CallMethodViaReflection", "TryReflect"}


def _children(node, *methods: str):
    for method in methods:
        found = getattr(node, method)()
        for i in range(found.size()):
            yield found.apply(i)


def _refuse_programs(plan) -> None:
    """Raise if an analysed plan, or a query within it, would run programs."""

    def check(expression) -> None:
        if expression.getClass().getSimpleName() in REFUSED_FUNCTIONS:
            raise ValueError("reflection is not allowed in a query")
        for child in _children(expression, "children"):
            check(child)

    if plan.nodeName() in REFUSED_NODES:
        raise ValueError("scripts are not allowed in a query")
    for expression in _children(plan, "expressions"):
        check(expression)
    for part in _children(plan, "children", "innerChildren", "subqueries"):
        if hasattr(part, "nodeName") and part.getClass().getName().startswith("org.apache.spark.sql"):
            _refuse_programs(part)


def _has_limit(plan) -> bool:
    """Whether the query inside ``SELECT * FROM (query)`` ends in a limit of its own."""
    for name in ("WithCTE", "Project", "SubqueryAlias", "WithCTE"):
        if plan.nodeName() == name:
            plan = list(_children(plan, "children"))[-1]
    return plan.nodeName() in ("GlobalLimit", "LocalLimit")


def run_sql(spark: SparkSession, sql: str, max_rows: int | None = MAX_ROWS) -> DataFrame:
    """A user's query over the registered views.

    A query without a limit of its own gives at most ``max_rows`` rows; None sets
    no cap. The text is placed where Spark's grammar allows a query and nothing
    else, so a statement that changes something is refused by Spark itself, and
    words such as ``created_at`` or 'CreateEvent' do no harm. Queries that would run
    scripts or call Java methods are refused once they are analysed. They are
    analysed in a copy of the session in which files cannot be named as tables.
    """
    text = sql.strip().rstrip(";").strip()
    if not text:
        raise ValueError("the query is empty")
    own = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
    own.conf.set("spark.sql.runSQLOnFiles", "false")
    found = own.sql(f"SELECT * FROM (\n{text}\n)")
    plan = found._jdf.queryExecution().analyzed()
    _refuse_programs(plan)
    return found if max_rows is None or _has_limit(plan) else found.limit(max_rows)
