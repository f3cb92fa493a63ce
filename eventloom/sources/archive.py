"""Hourly gzip JSON-lines archives.

Files are named ``{yyyy}-{MM}-{dd}-{H}.json.gz`` with the hour not padded. Each
line keeps its archive hour and its position in the file; together they are the
input order, which decides what "first seen" means in the ingest operators.
"""

from __future__ import annotations

import logging
from datetime import date, datetime, time, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventloom.functions.scratch import staged
from eventloom.functions.time_windows import date_text
from eventloom.schemas import ARCHIVE_LINE

log = logging.getLogger(__name__)

HOURS = range(24)
ARCHIVE_FILES = "*.json.gz"
LINE_SCHEMA = "value string, archive_hour timestamp_ntz, line_no bigint"


def as_date(value) -> date:
    return value if isinstance(value, date) else date.fromisoformat(value)


def file_glob(days, hours=HOURS) -> str:
    """Glob for the archive files of some days."""
    day_names = ",".join(date_text(as_date(d)) for d in days)
    hour_names = ",".join(str(h) for h in hours)
    return f"{{{day_names}}}-{{{hour_names}}}.json.gz"


def with_hour(text: DataFrame) -> DataFrame:
    """Scanned text with the ``archive_hour`` that its file name states."""
    hour = F.regexp_replace("_metadata.file_name", r"^(.+)-(\d+)\.json\.gz$", "$1 $2:00:00")
    return text.select("value", hour.try_cast("timestamp_ntz").alias("archive_hour"))


def number_lines(lines: DataFrame) -> DataFrame:
    """Add ``line_no`` to freshly scanned lines.

    A gzip file is never split, so row ids grow with the position in the file.
    They are taken at the scan, before any shuffle can reorder rows.
    """
    return lines.withColumn("line_no", F.monotonically_increasing_id())


def parse_lines(lines: DataFrame) -> DataFrame:
    """Archive lines as nested events.

    ``malformed`` marks lines that are not exactly one JSON object: cut off,
    blank, followed by more text, or of another JSON type. Each line is parsed
    as a list with one entry, so that text after the object is noticed.
    ``inline`` keeps filters on its columns above the parser; moved below it,
    they would parse each line once more.
    """
    listed = F.concat(F.lit("["), F.col("value"), F.lit("]"))
    events = F.from_json(listed, f"array<struct<{ARCHIVE_LINE}>>", {"allowSingleQuotes": "false"})
    one = F.coalesce(F.size("events") == 1, F.lit(False)) & F.col("events")[0].isNotNull()
    event = F.struct((~one).alias("malformed"), F.when(one, F.col("events")[0]).alias("event"))
    # A time that is null is told from one that is missing by the keys of the line.
    stated = F.array_contains(F.json_object_keys("value"), "created_at")
    null_time = F.when(F.col("event.created_at").isNull(), F.coalesce(stated, F.lit(False))).otherwise(False)
    return (
        lines.select("archive_hour", "line_no", "value", events.alias("events"))
        .select("archive_hour", "line_no", "value", F.inline(F.array(event)))
        .select("archive_hour", "line_no", "malformed", "event.*", null_time.alias("null_time"))
    )


def well_formed(raw: DataFrame) -> DataFrame:
    return raw.where("not malformed").drop("malformed")


def read_lines(text: DataFrame) -> DataFrame:
    """Parsed lines of scanned archive files, malformed ones included and marked.

    One task has to decompress a whole hour. The lines are rebalanced after that,
    so that parsing is not held up by an hour far larger than the others.
    """
    return parse_lines(number_lines(with_hour(text)).hint("rebalance"))


def read_archive(spark: SparkSession, paths) -> DataFrame:
    """Events of archive files; malformed lines are dropped."""
    return well_formed(read_lines(spark.read.text(paths)))


def load_hours(spark: SparkSession, root: str, days, hours=HOURS) -> tuple[DataFrame, list[tuple]]:
    """Parsed lines of some days as a staged table, and the damaged hours with their errors.

    A missing hour matches no file. All hours are read in one job; only when a
    file turns out damaged are the days, then the hours, halved until the bad
    ones are set apart. An hour counts whole or not at all.
    """
    text = spark.read.options(pathGlobFilter=file_glob(days, hours), ignoreCorruptFiles=False).text(root)
    try:
        return staged(read_lines(text), "archive"), []
    except Exception as error:
        if "FAILED_READ_FILE" not in str(error):
            raise
        reason = next(text for text in str(error).splitlines() if "FAILED_READ_FILE" in text)
    if len(days) == len(hours) == 1:
        at = datetime.combine(as_date(days[0]), time(hours[0]))
        log.warning("hour %s cannot be read: %s", at, reason)
        return parse_lines(spark.createDataFrame([], LINE_SCHEMA)), [(at, reason)]
    if len(days) > 1:
        half = len(days) // 2
        parts = (days[:half], hours), (days[half:], hours)
    else:
        half = len(hours) // 2
        parts = (days, hours[:half]), (days, hours[half:])
    (first, bad), (second, worse) = (load_hours(spark, root, *part) for part in parts)
    return first.union(second), bad + worse


def stage_lines(spark: SparkSession, root: str, days, hours=HOURS) -> DataFrame:
    """Parsed lines of some days as a staged table, without unreadable hours, which are logged."""
    return load_hours(spark, root, days, hours)[0]


def hour_report(lines: DataFrame, damaged: list[tuple], days, hours=HOURS) -> DataFrame:
    """What became of every hour that was asked for: archive_hour, state, lines, error.

    ``lines`` and ``damaged`` come from ``load_hours``. A state is loaded, missing or
    damaged; an hour whose file holds no line counts as missing.
    """
    spark = lines.sparkSession
    asked = [(datetime.combine(as_date(d), time(h)),) for d in days for h in hours]
    expected = spark.createDataFrame(asked, "archive_hour timestamp_ntz")
    found = lines.groupBy("archive_hour").agg(F.count("*").alias("lines"))
    broken = spark.createDataFrame(damaged, "archive_hour timestamp_ntz, error string")
    state = F.when(F.col("error").isNotNull(), "damaged").when(F.col("lines") > 0, "loaded").otherwise("missing")
    return (
        expected.join(found, "archive_hour", "left")
        .join(broken, "archive_hour", "left")
        .select("archive_hour", state.alias("state"), F.coalesce("lines", F.lit(0)).alias("lines"), "error")
    )


def ingest_report(spark: SparkSession, root: str, start, end) -> DataFrame:
    """``hour_report`` of all hours from ``start`` to ``end``."""
    days = days_between(start, end)
    return hour_report(*load_hours(spark, root, days), days)


def days_between(start, end) -> list[date]:
    first, last = as_date(start), as_date(end)
    return [first + timedelta(days=n) for n in range((last - first).days + 1)]


def ingest_range(spark: SparkSession, root: str, start, end) -> DataFrame:
    """Events of all days from ``start`` to ``end``, both included."""
    return well_formed(stage_lines(spark, root, days_between(start, end)))


def ingest_day(spark: SparkSession, root: str, day) -> DataFrame:
    """Events of the hours of one day that exist and can be read."""
    return ingest_range(spark, root, day, day)


def ingest_hour(spark: SparkSession, root: str, day, hour: int) -> DataFrame:
    """Events of one hour, 0 to 23; a missing or damaged file is an error."""
    if hour not in HOURS:
        raise ValueError("hour must be between 0 and 23")
    return read_archive(spark, f"{root.rstrip('/')}/{date_text(as_date(day))}-{hour}.json.gz")
