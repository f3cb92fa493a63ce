"""Which version of each published table is the current one.

A publication is a numbered list of tables and their folders, one small file below
``_current``. It is put in place by one rename once all its tables are written, so
readers see all of a refresh or nothing of it, and find tables by name at any time.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from eventloom.functions.scratch import delete_folders

LISTS = "_current"


def files_of(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return path, path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def publications(spark: SparkSession, root: str) -> list[int]:
    """The numbers of all publications that are kept, in order."""
    path, fs = files_of(spark, root)
    found = fs.globStatus(path(f"{root.rstrip('/')}/{LISTS}/*.json"))
    return sorted(int(status.getPath().getName().removesuffix(".json")) for status in found or [])


def list_path(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/{LISTS}/{number:08d}.json"


def folders(spark: SparkSession, root: str, number: int | None = None) -> dict[str, str]:
    """The folder of every table in a publication, by default the current one; none before the first."""
    if number is None:
        numbers = publications(spark, root)
        if not numbers:
            return {}
        number = numbers[-1]
    text = "".join(row.value for row in spark.read.text(list_path(root, number), wholetext=True).collect())
    return json.loads(text)


def current(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table by name, as the last publication has it."""
    stored = folders(spark, root)
    if name not in stored:
        raise ValueError(f"not published: {name!r}")
    return spark.read.parquet(stored[name])


def point_to(spark: SparkSession, root: str, new: dict[str, str]) -> int:
    """Make ``new`` folders current, beside those of other tables; returns the publication's number.

    Of two publishers at the same time one fails, and nothing of its list is seen.
    """
    number = max(publications(spark, root), default=0) + 1
    content = json.dumps({**folders(spark, root), **new}, sort_keys=True)
    path, fs = files_of(spark, root)
    written, target = path(f"{root.rstrip('/')}/{LISTS}/.{uuid.uuid4().hex}"), path(list_path(root, number))
    out = fs.create(written, False)
    out.write(bytearray(content.encode()))
    out.close()
    if fs.exists(target) or not fs.rename(written, target):
        fs.delete(written, False)
        raise RuntimeError(f"publication {number} below {root} was made by another job meanwhile")
    return number


def clean(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete the folders that only publications before the last ``keep`` name, and those lists.

    Folders that no list names, such as one that is being written, are left alone.
    """
    numbers = publications(spark, root)
    old, kept = numbers[:-keep] if keep else numbers, numbers[-keep:] if keep else []
    used = {folder for number in kept for folder in folders(spark, root, number).values()}
    gone = sorted({folder for number in old for folder in folders(spark, root, number).values()} - used)
    delete_folders(spark, gone)
    delete_folders(spark, (list_path(root, number) for number in old))
    return gone
