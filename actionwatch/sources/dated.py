"""Tables in day partitions behind a manifest, of which a window can be rebuilt (LIF-12)."""

from __future__ import annotations

import datetime
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import versions

#: The partition of rows without a date.
UNDATED = -(10**6)


def _day(date: str) -> Column:
    return F.coalesce(F.unix_date(F.col(date).cast("date")), F.lit(UNDATED)).alias("_day")


def create(df: DataFrame, path: str, *, date: str = "date") -> int:
    """Version 1 of a table. Raises where there is a version."""
    folders = versions.put(df.select("*", _day(date)), path, "_day")
    return versions.commit(df.sparkSession, path, 0, {"date": date, "schema": json.loads(df.schema.json()), "folders": folders})


def read(spark: SparkSession, path: str, version: int | None = None, days: set[int] | None = None) -> DataFrame:
    """The newest version, or a chosen one; only some days (since 1970-01-01), where given."""
    _, m = versions.load(spark, path, version)
    if not m:
        raise FileNotFoundError(f"{path} has no version")
    return versions.get(spark, path, m["folders"], StructType.fromJson(m["schema"]), days)


def rebuild(rebuilt: DataFrame, path: str, *, floor: datetime.date, scope: Column | None = None) -> int:
    """The next version: from ``floor`` on the rebuilt rows stand, earlier and undated ones stay (LIF-12).

    With ``scope`` (one state's rows, say) only rows in it are cleared and taken. Days before the floor, and days on
    which neither side has a row in scope, keep their files. Rebuilt rows before the floor or without a date are left
    out. All of it shows at once, or nothing.
    """
    spark = rebuilt.sparkSession
    after, m = versions.load(spark, path)
    first, inside = (floor - datetime.date(1970, 1, 1)).days, F.lit(True) if scope is None else F.coalesce(scope, F.lit(False))
    schema, later = StructType.fromJson(m["schema"]), {int(k) for k in m["folders"] if int(k) >= first}
    new = rebuilt.select(*schema.names, _day(m["date"])).where((F.col("_day") >= first) & inside)
    if scope is None:
        touched = later
    else:
        old = versions.get(spark, path, m["folders"], schema, later).select("*", _day(m["date"]))
        days = old.where(inside).select("_day").unionByName(new.select("_day")).distinct()
        touched = {r[0] for r in days.collect()}  # a row a day
        new = old.where(F.col("_day").isin(sorted(touched)) & ~inside).unionByName(new)
    folders = versions.put(new, path, "_day")
    return versions.commit(spark, path, after, m | {"folders": {k: v for k, v in m["folders"].items() if int(k) not in touched} | folders})
