"""URL filters: host and path rules by a sort-merge range join.

A host's labels are reversed and joined with dots, so that a rule's host and all its
subdomains form one interval of keys, and intervals either nest or are apart. Pages
and rules are range-partitioned on that key and sorted; one sweep per partition
keeps the stack of the rules whose intervals hold the current key.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL_PATTERN = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: Split points of the sort: cells per shuffle partition, and sampled keys per cell.
CELLS, SAMPLED = 2, 50
LAST = "\U0010ffff"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), URL_PATTERN, 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), URL_PATTERN, 2)


def reversed_key(host: Column) -> Column:
    """``a.example.net`` as ``net.example.a.``; the empty host as the empty key."""
    labels = F.array_join(F.reverse(F.split(host, r"\.")), ".")
    return F.when(host == "", F.lit("")).otherwise(F.concat(labels, F.lit(".")))


def split_points(keys: DataFrame, cells: int) -> list[str]:
    """At most ``cells`` - 1 keys that cut a sample of ``keys`` evenly.

    The sample has about SAMPLED keys for each cell, whatever the input's size. It
    decides only how evenly work is dealt, never a result.
    """
    share = min(1.0, 1.2 * cells * SAMPLED / max(1, keys.count()))
    sample = sorted(row[0] for row in keys.sample(share, 7).limit(4 * cells * SAMPLED).collect())
    return sorted({sample[len(sample) * i // cells] for i in range(1, cells)}) if sample else []


def sweep(batches: Iterable[pa.RecordBatch], default: str) -> Iterator[pa.RecordBatch]:
    """Verdicts for rows sorted by (cell, key, kind): rules (kind 0) and pages (kind 1)."""
    stack: list[tuple[str, dict, list[int]]] = []  # key, rules by path, path lengths
    at = None
    for batch in batches:
        out = {name: [] for name in ("place", "rule", "verdict")}
        rows = (batch.column(c).to_pylist() for c in ("cell", "key", "kind", "host", "path", "verdict"))
        for i, (cell, key, kind, host, path, verdict) in enumerate(zip(*rows)):
            if cell != at:
                at, stack = cell, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if kind == 0:
                if not stack or stack[-1][0] != key:
                    stack.append((key, {}, []))
                _, of_path, lengths = stack[-1]
                known = of_path.get(path)
                of_path[path] = (host, max(known[1], verdict) if known else verdict)
                if len(path) not in lengths:
                    lengths.append(len(path))
                continue
            best = ("", "", default)
            for _, of_path, lengths in stack:
                for n in lengths:
                    if rule := of_path.get(path[:n]) if n <= len(path) else None:
                        text = rule[0] + path[:n]
                        best = max(best, (text, *rule), key=lambda r: (len(r[0]), len(r[1])))
            for name, value in zip(out, (i, best[0] or None, best[2])):
                out[name].append(value)
        kept = batch.select(["page", "host", "path"]).take(pa.array(out["place"], pa.int64()))
        texts = [pa.array(out[name], pa.string()) for name in ("rule", "verdict")]
        yield pa.RecordBatch.from_arrays(
            [*kept.columns, *texts], names=["page", "host", "path", "rule", "verdict"]
        )


def judge(pages: DataFrame, rules: DataFrame, key: str = "page_id", default: str = "allow") -> DataFrame:
    """Per page: ``key``, host, path, rule, verdict.

    ``rules`` has host, path and verdict. A rule fits its host and all subdomains when
    the page's path starts with the rule's. The longest rule (host and path together,
    then host) wins; of rules alike, the greater verdict (block before allow).
    ``default`` is the verdict where none fits.

    A null url, or one without ``://``, has empty host and path and fits no rule; a
    rule without host is left out, a null path is the empty one. Repeated pages get a
    row each. Of ``pages`` only ``key`` and url are read. The key column must not be
    an array or struct.
    """
    spark = pages.sparkSession
    cells = CELLS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    parsed = pages.select(F.col(key).alias("page"), F.col("url").alias("url")).select(
        "page", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "url"
    )
    salt = F.hex(F.xxhash64("page", "url"))  # cuts a hot host into several cells
    placed = parsed.select(
        F.concat(reversed_key(F.col("host")), F.lit("\0"), salt).alias("key"),
        F.lit(1).alias("kind"),
        "page",
        "host",
        "path",
        F.lit(None).cast("string").alias("verdict"),
    )
    points = split_points(placed.select("key"), cells)

    @F.pandas_udf("int")
    def cell_of(keys: pd.Series) -> pd.Series:
        return keys.map(lambda k: bisect_right(points, k)).astype("int32")

    columns = ["cell", "key", "kind", "page", "host", "path", "verdict"]
    page_type = parsed.schema["page"].dataType
    intervals = rules.where("host is not null and host != ''").select(
        reversed_key(F.translate("host", UPPER, LOWER)).alias("key"),
        F.lit(0).alias("kind"),
        F.lit(None).cast(page_type).alias("page"),
        F.translate("host", UPPER, LOWER).alias("host"),
        F.coalesce("path", F.lit("")).alias("path"),
        "verdict",
    )
    # A rule goes to every cell that its interval meets: those are the rules that are
    # active where a cell begins, never more than nest around one key.
    met = F.sequence(cell_of("key"), cell_of(F.concat("key", F.lit(LAST))))
    events = (
        placed.withColumn("cell", cell_of("key"))
        .select(columns)
        .unionByName(intervals.withColumn("cell", F.explode(met)).select(columns))
        .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "cell")
        .sortWithinPartitions("cell", "key", "kind")
    )
    schema = f"page {page_type.simpleString()}, host string, path string, rule string, verdict string"
    judged = events.mapInArrow(lambda batches: sweep(batches, default), schema)
    return judged.withColumnRenamed("page", key)
