"""Keyed tables in buckets of the key's hash (SRC-11, LIF-07).

A version's manifest points to the folders of every bucket. A merge reads the buckets that its rows fall into, writes
those in which a row has changed, and points to the old folders of all others. Two versions differ only where their
folders do, so what has changed between them is read from those buckets alone.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import blank_to_null
from ..operators.lifecycle import accrete, upsert
from ..operators.shared import written
from . import versions

#: Buckets of a new table; choose it so that a bucket fits well into a task.
BUCKETS = 64


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int")


def create(df: DataFrame, path: str, *, key: str, buckets: int = BUCKETS) -> int:
    """Version 1 of a table with one row for each key. Raises where there is a version."""
    spark = df.sparkSession
    folders = versions.put(df.withColumn("_bucket", bucket_of(F.col(key), buckets)), path, "_bucket")
    return versions.commit(spark, path, 0, {"key": key, "buckets": buckets, "schema": json.loads(df.schema.json()), "folders": folders})


def number(spark: SparkSession, path: str) -> int:
    """The number of the newest version; 0 where there is none."""
    return versions.numbers(spark, f"{path}/{versions.FOLDER}")[0]


def read(spark: SparkSession, path: str, version: int | None = None, buckets: set[int] | None = None) -> DataFrame:
    """The newest version, or a chosen one; only some buckets, where given."""
    _, m = versions.load(spark, path, version)
    if not m:
        raise FileNotFoundError(f"{path} has no version")
    return versions.get(spark, path, m["folders"], StructType.fromJson(m["schema"]), buckets)


def merge(rows: DataFrame, path: str, step: Callable[[DataFrame, DataFrame], DataFrame]) -> dict[str, int]:
    """Merge rows into a table: ``step(old, rows)`` gives the buckets' new rows with a ``change`` column.

    ``rows`` have the table's key; blank keys are skipped. Only buckets in which a row is created or updated are
    replaced, and where there is none no version is written (STR-07). Returns the number of rows of each change in the
    buckets that were looked at. A second writer's version in between makes this one raise and change nothing.
    """
    spark = rows.sparkSession
    after, m = versions.load(spark, path)
    key, n = m["key"], m["buckets"]
    bucket = bucket_of(F.col(key), n).alias("_bucket")
    rows = rows.where(blank_to_null(F.col(key).cast("string")).isNotNull())
    # Written, so that all readings below see the same rows.
    rows = written(rows.select("*", bucket), "merge-rows")
    touched = {r[0] for r in rows.select("_bucket").distinct().collect()}  # at most as many as there are buckets
    changed = step(read(spark, path, after, touched), rows.drop("_bucket"))
    folders = versions.put(changed.select("*", bucket), path, "_bucket")
    if not folders:
        return {}
    whole = next(iter(folders.values()))[0].rpartition("/")[0]
    found = spark.read.parquet(f"{path}/{whole}").groupBy("_bucket", "change").count().collect()  # three rows a bucket
    kept = {str(r[0]) for r in found if r[1] != "unchanged"}
    for k in folders.keys() - kept:
        versions.delete(spark, f"{path}/{folders[k][0]}")
    if kept:
        versions.commit(spark, path, after, m | {"folders": m["folders"] | {k: folders[k] for k in kept}})
    else:
        versions.delete(spark, f"{path}/{whole}")
    counts: dict[str, int] = {}
    for _, change, c in found:
        counts[change] = counts.get(change, 0) + c
    return counts


def upsert_into(batch: DataFrame, path: str, *, order: str, preserve: list[str] = (), buckets: int = BUCKETS, key: str | None = None) -> dict[str, int]:
    """``lifecycle.upsert`` into a stored table. A missing one is made, of the batch's columns, where ``key`` is given."""
    spark = batch.sparkSession
    if not number(spark, path):
        if key is None:
            raise FileNotFoundError(f"{path} has no version")
        create(batch.limit(0), path, key=key, buckets=buckets)
    key = versions.load(spark, path)[1]["key"]
    return merge(batch, path, lambda old, rows: upsert(old, rows, key=key, order=order, preserve=preserve))


def accrete_into(additions: DataFrame, path: str, *, regenerated: list[str] = ()) -> dict[str, int]:
    """``lifecycle.accrete`` into a stored table of events (LIF-08, LIF-09)."""
    key = versions.load(additions.sparkSession, path)[1]["key"]

    def step(old: DataFrame, rows: DataFrame) -> DataFrame:
        grown = accrete(old, rows, key=key, regenerated=regenerated)
        changed = F.col("new_urls") > 0
        if regenerated:
            before = old.select(key, F.struct(*regenerated).alias("_before"))
            grown = grown.join(before, key)
            changed = changed | ~F.col("_before").eqNullSafe(F.struct(*regenerated))
        return grown.withColumn("change", F.when(changed, "updated").otherwise("unchanged")).drop("new_urls", "_before")

    return merge(additions, path, step)


def changes(spark: SparkSession, path: str, old: int, new: int) -> DataFrame:
    """(key, old, new, change) of rows created, updated or deleted between two versions.

    Only buckets whose folders differ are read.
    """
    (_, a), (_, b) = versions.load(spark, path, old), versions.load(spark, path, new)
    differ = {int(k) for k in a["folders"].keys() | b["folders"].keys() if a["folders"].get(k) != b["folders"].get(k)}
    key = b["key"]

    def side(m: dict, name: str) -> DataFrame:
        rows = versions.get(spark, path, m["folders"], StructType.fromJson(m["schema"]), differ)
        return rows.select(key, F.struct(*(c for c in rows.columns if c != key)).alias(name))

    both = side(a, "old").join(side(b, "new"), key, "full_outer")
    change = F.when(F.col("old").isNull(), "created").when(F.col("new").isNull(), "deleted").when(~F.col("old").eqNullSafe(F.col("new")), "updated")
    return both.select(key, "old", "new", change.alias("change")).where("change is not null")
