"""Domain tables from the given tables, in Spark and, as text, for DuckDB.

Both engines get the same SQL, apart from the spelling of three functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from eventloom.functions.scratch import new_path

AS_OF = "2024-01-31 12:00:00"
STREAM_FILES = 50
ARRIVALS_PER_BATCH = 5
#: The actor of the event that ends a stream of arrivals.
CLOSING = -1

DUCKDB = {
    "K": "CAST(json_extract_string(props, '$.k') AS BIGINT)",
    "NTZ": "TIMESTAMP",
    "ISO": "strftime(created_at, '%Y-%m-%dT%H:%M:%SZ')",
}
SPARK = {
    "K": "CAST(get_json_object(props, '$.k') AS BIGINT)",
    "NTZ": "TIMESTAMP_NTZ",
    "ISO": "date_format(created_at, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")",
}

EVENTS = """
SELECT event_id AS gh_event_id,
       CASE WHEN t = 'view' THEN 'WatchEvent'
            WHEN t = 'click' THEN 'ForkEvent'
            WHEN t = 'signup' THEN 'PullRequestEvent'
            WHEN t = 'purchase' THEN 'PushEvent'
            WHEN k % 3 = 0 THEN 'CreateEvent'
            WHEN k % 3 = 1 THEN 'DeleteEvent'
            ELSE 'IssuesEvent' END AS event_type,
       1 AS public, ts AS created_at, CAST(ts AS DATE) AS created_at_date,
       user_id + 1 AS actor_id, k + 1 AS repo_id,
       CASE WHEN k % 4 = 0 THEN CAST(floor(k / 4) AS BIGINT) + 1 END AS org_id,
       'dev-' || CAST(user_id AS VARCHAR(20)) AS actor_login,
       'org/repo-' || CAST(k AS VARCHAR(20)) AS repo_name
FROM (SELECT event_id, ts, user_id, event_type AS t, {K} AS k FROM events) x
"""

ACTORS = """
SELECT c_custkey + 1 AS actor_id, 'dev-' || CAST(c_custkey AS VARCHAR(20)) AS login,
       c_name AS display_login, '' AS gravatar_id, '' AS url, '' AS avatar_url,
       CAST(c_nationkey AS BIGINT) AS total_events, CAST(0 AS BIGINT) AS total_repos,
       CASE WHEN c_custkey % 2 = 0 THEN CAST({NTZ} '2024-01-15 00:00:00' AS {NTZ}) END
           AS last_active_at
FROM customer
"""

REPOS = """
SELECT p_partkey + 1 AS repo_id, 'org/repo-' || CAST(p_partkey AS VARCHAR(20)) AS name,
       '' AS url, CAST(p_size AS BIGINT) AS total_stars,
       CAST(p_partkey % 7 AS BIGINT) AS total_forks, CAST(0 AS BIGINT) AS total_events,
       CAST(p_partkey % 200 AS BIGINT) AS total_contributors,
       CASE WHEN p_partkey % 2 = 0 THEN CAST({NTZ} '2024-01-15 00:00:00' AS {NTZ}) END
           AS last_event_at,
       p_brand AS language
FROM part
"""

ORGS = "SELECT s_suppkey + 1 AS org_id, s_name AS login FROM supplier"

# Dimensions as they were before the raw lines below arrive: one market segment
# of the actors, the repositories with few stars, the organizations in debt.
STORED_ACTORS = """
SELECT a.* FROM actors a JOIN customer ON c_custkey + 1 = a.actor_id
WHERE c_mktsegment = 'BUILDING'
"""
STORED_REPOS = "SELECT r.* FROM repos r WHERE r.total_stars <= 10"
STORED_ORGS = """
SELECT o.* FROM orgs o JOIN supplier ON s_suppkey + 1 = o.org_id WHERE s_acctbal < 0
"""

# Every event as an archive line. Some lines are cut off, lack an actor, a
# repository or a valid time, or come twice; some actors appear under a second
# name, under a second id with a name already taken, or with an overlong name.
# The lines of six hours share the file of the first.
WHOLE_LINES = """
SELECT id, archive_hour,
    '{{"id":"' || CAST(id AS VARCHAR(20)) || '","type":"' || event_type || '"'
    || ',"actor":' || CASE
         WHEN id % 89 = 1 THEN 'null'
         WHEN id % 83 = 3 THEN '{{"id":0,"login":"ghost"}}'
         ELSE '{{"id":' || CASE WHEN id % 61 = 7 THEN CAST(u + 1000001 AS VARCHAR(20))
                               ELSE CAST(u + 1 AS VARCHAR(20)) END
           || ',"login":"' || CASE WHEN id % 61 = 7 THEN 'DEV-' ELSE 'dev-' END
           || CASE WHEN id % 71 = 5 THEN 'renamed-' ELSE '' END
           || CAST(u AS VARCHAR(20))
           || CASE WHEN u % 10 = 9 THEN repeat('x', 120) ELSE '' END || '"'
           || CASE WHEN id % 7 <> 0 THEN ',"display_login":"Dev ' || CAST(u AS VARCHAR(20)) || '"'
                   ELSE '' END
           || ',"gravatar_id":"","url":"https://host.example/users/' || CAST(u AS VARCHAR(20))
           || '","avatar_url":"https://host.example/pictures/' || CAST(u AS VARCHAR(20)) || '"}}'
         END
    || ',"repo":' || CASE
         WHEN id % 67 = 4 THEN 'null'
         ELSE '{{"id":' || CAST(k + 1 AS VARCHAR(20)) || ',"name":"org/repo-' || CAST(k AS VARCHAR(20))
           || '","url":"https://host.example/repos/' || CAST(k AS VARCHAR(20)) || '"}}' END
    || CASE WHEN k % 4 = 0
              THEN ',"org":{{"id":' || CAST(org_id AS VARCHAR(20)) || ',"login":"team-'
                   || CAST(org_id AS VARCHAR(20)) || '","gravatar_id":"","url":"https://host.example/teams/'
                   || CAST(org_id AS VARCHAR(20)) || '","avatar_url":""}}'
            WHEN k % 4 = 1 THEN ',"org":null' ELSE '' END
    || CASE WHEN id % 103 = 11 THEN ''
            WHEN id % 101 = 9 THEN ',"created_at":"not a time"'
            WHEN id % 107 = 13 THEN ',"created_at":null'
            WHEN id % 109 = 17 THEN ',"created_at":"2024"'
            WHEN id % 113 = 19 THEN ',"created_at":"0000-01-01T00:00:00Z"'
            WHEN id % 127 = 23 THEN ',"created_at":"0999-06-15T08:00:00Z"'
            ELSE ',"created_at":"' || iso || '"' END
    || ',"public":' || CASE WHEN id % 13 = 0 THEN 'false' ELSE 'true' END
    || ',"payload":' || CASE
         WHEN event_type = 'PushEvent' AND id % 9 = 0
           THEN '{{"push_id":' || CAST(id * 10 AS VARCHAR(20)) || ',"head":null}}'
         WHEN event_type = 'PushEvent'
           THEN '{{"push_id":' || CAST(id * 10 AS VARCHAR(20)) || ',"size":' || CAST(k % 5 AS VARCHAR(20))
                || ',"distinct_size":' || CAST(k % 3 AS VARCHAR(20)) || ',"head":"' || repeat('ab', 60)
                || '","ref":"refs/heads/branch-' || CAST(k AS VARCHAR(20)) || '"}}'
         WHEN event_type = 'ForkEvent' AND id % 9 = 0
           THEN '{{"forkee":{{"id":' || CAST(id + 500000 AS VARCHAR(20)) || ',"full_name":null}}}}'
         WHEN event_type = 'ForkEvent'
           THEN '{{"forkee":{{"id":' || CAST(id + 500000 AS VARCHAR(20)) || ',"full_name":"dev-'
                || CAST(u AS VARCHAR(20)) || '/repo-' || CAST(k AS VARCHAR(20)) || '"}}}}'
         WHEN event_type = 'CreateEvent' AND id % 2 = 0
           THEN '{{"ref":null,"ref_type":"repository","description":null}}'
         WHEN event_type = 'CreateEvent'
           THEN '{{"ref":"feature-' || CAST(k AS VARCHAR(20))
                || '","ref_type":"branch","description":"a new line of work"}}'
         ELSE '{{}}' END
    || '}}' AS line
FROM (SELECT gh_event_id AS id, event_type, actor_id - 1 AS u, repo_id - 1 AS k, org_id,
             CAST(date_trunc('hour', created_at
                  - INTERVAL '1' HOUR * (extract(hour FROM created_at) % 6)) AS {NTZ}) AS archive_hour,
             {ISO} AS iso
      FROM gh_events) e
"""

LINES = """
SELECT archive_hour, line_no,
       CASE WHEN id % 97 = 0 THEN left(line, length(line) - 10) ELSE line END AS value
FROM (SELECT id, archive_hour, id * 2 AS line_no, line FROM whole_lines
      UNION ALL
      SELECT id, archive_hour, id * 2 + 1 AS line_no, line FROM whole_lines
      WHERE id % 50 = 2 OR id % 113 = 19 OR id % 127 = 23) l
"""

# Every eleventh event arrives three days late.
ARRIVALS = """
SELECT *, CASE WHEN gh_event_id % 11 = 0 THEN CAST(created_at_date + INTERVAL '3' DAY AS DATE)
               ELSE created_at_date END AS arrival
FROM gh_events
"""

# Tables that build on the given ones, in order.
DEFINITIONS = {
    "gh_events": EVENTS,
    "actors": ACTORS,
    "repos": REPOS,
    "orgs": ORGS,
    "stored_actors": STORED_ACTORS,
    "stored_repos": STORED_REPOS,
    "stored_orgs": STORED_ORGS,
    "whole_lines": WHOLE_LINES,
    "lines": LINES,
    "arrivals": ARRIVALS,
}
GIVEN = ("events", "customer", "part", "supplier")
USES = {
    "gh_events": ("events",),
    "actors": ("customer",),
    "repos": ("part",),
    "orgs": ("supplier",),
    "stored_actors": ("actors", "customer"),
    "stored_repos": ("repos",),
    "stored_orgs": ("orgs", "supplier"),
    "whole_lines": ("gh_events",),
    "lines": ("whole_lines",),
    "arrivals": ("gh_events",),
}


def needed(*names: str) -> list[str]:
    """The definitions that some tables build on, in order, given ones left out."""
    wanted = set()

    def visit(name: str) -> None:
        if name not in GIVEN and name not in wanted:
            wanted.add(name)
            for used in USES[name]:
                visit(used)

    for name in names:
        visit(name)
    return [name for name in DEFINITIONS if name in wanted]


def duckdb_with(*names: str) -> str:
    """A WITH clause that defines some tables for DuckDB."""
    parts = (f"{n} AS ({DEFINITIONS[n].format(**DUCKDB)})" for n in needed(*names))
    return "WITH " + ", ".join(parts)


_schemas: dict[str, StructType] = {}


def given_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is read from the file once."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def spark_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A domain table in Spark."""
    steps = needed(name)
    for given in {g for step in steps for g in USES[step] if g in GIVEN}:
        given_table(spark, sf_dir, given).createOrReplaceTempView(given)
    parts = (f"{n} AS ({DEFINITIONS[n].format(**SPARK)})" for n in steps)
    return spark.sql("WITH " + ", ".join(parts) + f" SELECT * FROM {name}")


def write_archive(spark: SparkSession, sf_dir: str) -> str:
    """The raw lines as hour files; returns their folder.

    Spark writes one file per hour; each is then given the archive's name and a
    modification time in hour order, since a stream takes files in that order.
    """
    hour = F.date_format("archive_hour", "yyyy-MM-dd-H").alias("hour")
    lines = spark_table(spark, sf_dir, "lines").select(hour, "line_no", "value")
    written = new_path(spark, "hours")
    (
        lines.repartition(spark.sparkContext.defaultParallelism, "hour")
        .sortWithinPartitions("hour", "line_no")
        .select("hour", "value")
        .write.partitionBy("hour")
        .option("compression", "gzip")
        .text(written)
    )
    return in_order(spark, written, "hour", "archive", ".json.gz", lambda name: (name[:10], int(name[11:])))


def in_order(spark: SparkSession, written: str, column: str, label: str, suffix: str, order) -> str:
    """One file for each folder of ``written``, with modification times in their order; returns their folder."""
    root = new_path(spark, label)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(written).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path(root))
    parts = fs.globStatus(path(f"{written}/{column}=*/part-*"))
    names = {}
    for status in parts:
        name = status.getPath().getParent().getName().removeprefix(f"{column}=")
        names[name] = status.getPath()
    first_time = parts[0].getModificationTime() - 1000 * len(names)
    for n, name in enumerate(sorted(names, key=order)):
        target = path(f"{root}/{name}{suffix}")
        fs.rename(names[name], target)
        fs.setTimes(target, first_time + 1000 * n, -1)
    return root


def write_arrivals(spark: SparkSession, sf_dir: str) -> str:
    """The events as files in the order of their arrival, some days late; returns their folder.

    The last file holds one event long after the others, which closes what they left open.
    """
    arrivals = spark_table(spark, sf_dir, "arrivals")
    written = new_path(spark, "arrivals")
    closing = arrivals.limit(1).withColumns(
        {
            "actor_id": F.lit(CLOSING).cast("bigint"),
            "created_at": F.expr("TIMESTAMP_NTZ'2024-06-01 00:00:00'"),
            "created_at_date": F.expr("DATE'2024-06-01'"),
            "arrival": F.expr("DATE'2024-06-01'"),
        }
    )
    both = arrivals.union(closing.select(*arrivals.columns))
    both.repartition(spark.sparkContext.defaultParallelism, "arrival").write.partitionBy("arrival").parquet(written)
    return in_order(spark, written, "arrival", "arriving", ".parquet", str)


def damaged_archive(spark: SparkSession, root: str, day: str, cut_off: int, absent: int) -> str:
    """The hour files of one day in a new folder, one of them cut off and one left out."""
    jvm, configuration = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    to = new_path(spark, "damaged")
    fs = path(root).getFileSystem(configuration)
    fs.mkdirs(path(to))
    for status in fs.globStatus(path(f"{root}/{day}-*.json.gz")):
        name = status.getPath().getName()
        hour = int(name.removeprefix(f"{day}-").removesuffix(".json.gz"))
        if hour == cut_off:
            content = spark.read.format("binaryFile").load(status.getPath().toString()).first().content
            out = fs.create(path(f"{to}/{name}"))
            out.write(bytes(content[: len(content) // 2]))
            out.close()
        elif hour != absent:
            jvm.org.apache.hadoop.fs.FileUtil.copy(fs, status.getPath(), fs, path(f"{to}/{name}"), False, configuration)
    return to
