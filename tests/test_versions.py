"""Versioned tables: crashes at every step, buckets, changes between versions."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from actionwatch.sources import keyed, tables, versions


def files(path):
    return {str(p) for p in Path(path, "data").rglob("*.parquet")}


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def stored(spark, tmp_path):
    path = f"{tmp_path}/t"
    keyed.create(spark.range(400).select(F.concat(F.lit("k"), "id").alias("id"), F.col("id").alias("v"), F.lit("").alias("note")), path, key="id", buckets=16)
    return path


def test_upsert_writes_only_buckets_with_a_change(spark, stored):
    before, seen = files(stored), keyed.read(spark, stored)
    batch = seen.withColumn("bucket", keyed.bucket_of(F.col("id"), 16)).where("bucket = 3").select("id", (F.col("v") + 1000).alias("v"), "note", F.lit(1).alias("seq"))
    n = batch.count()
    assert keyed.upsert_into(batch, stored, order="seq") == {"updated": n}
    fresh = files(stored) - before
    assert fresh and all("_bucket=3/" in f for f in fresh) and before <= files(stored)
    now = keyed.read(spark, stored)
    assert now.count() == 400 and now.where("v >= 1000").count() == n and now.columns == ["id", "v", "note"]
    # Rows as they are, in other buckets: looked at, nothing written.
    again = now.where("v < 1000").limit(50).withColumn("seq", F.lit(1))
    assert set(keyed.upsert_into(again, stored, order="seq")) == {"unchanged"} and keyed.number(spark, stored) == 2
    assert files(stored) - before == fresh
    assert rows(keyed.read(spark, stored, version=1)) == rows(spark.range(400).select(F.concat(F.lit("k"), "id"), "id", F.lit("")))


def test_upsert_rules(spark, tmp_path):
    path = f"{tmp_path}/t"
    batch = spark.createDataFrame([("a", "x", "", 1), ("a", "y", "", 2), ("", "z", "", 1), (None, "z", "", 1), ("b", "q", "n", 1)], "id string, v string, note string, seq int")
    with pytest.raises(FileNotFoundError):
        keyed.upsert_into(batch, path, order="seq")
    assert keyed.upsert_into(batch, path, order="seq", key="id", preserve=["note"], buckets=4) == {"created": 2}
    more = spark.createDataFrame([("b", "r", "other", 1), ("c", "s", "", 1)], "id string, v string, note string, seq int")
    assert keyed.upsert_into(more, path, order="seq", preserve=["note"])["updated"] == 1
    assert rows(keyed.read(spark, path).select("id", "v", "note")) == [("a", "y", ""), ("b", "r", "n"), ("c", "s", "")]
    assert keyed.upsert_into(more.limit(0), path, order="seq") == {}


@pytest.mark.parametrize("step", ["put", "publish", "rename"])
def test_crash_at_any_step_leaves_the_table_writable(spark, stored, monkeypatch, step):
    def die(*a, **b):
        raise KeyboardInterrupt

    batch = spark.createDataFrame([("k1", 7, "", 1)], "id string, v long, note string, seq int")
    with monkeypatch.context() as m:
        if step == "put":
            m.setattr(versions, "put", die)
        elif step == "publish":
            m.setattr(versions, "publish", die)
        else:
            # A writer that dies with its draft written: an empty number, and drafts without one.
            folder = Path(stored, versions.FOLDER)
            (folder / f"{2:012d}").touch()
            (folder / ".draft-dead").write_text("{")
            m.setattr(versions, "commit", die)
        with pytest.raises(KeyboardInterrupt):
            keyed.upsert_into(batch, stored, order="seq")
    assert keyed.number(spark, stored) == 1 and keyed.read(spark, stored).where("v = 7").count() == 1
    assert keyed.upsert_into(batch, stored, order="seq")["updated"] == 1
    assert keyed.read(spark, stored).where("id = 'k1' and v = 7").count() == 1
    versions.expire(spark, stored, keep=1, grace_s=-10)
    assert keyed.read(spark, stored).count() == 400
    left = {Path(f).parents[1].name for f in files(stored)}
    assert left <= versions._folders(versions.load(spark, stored)[1])


def test_second_writer_raises_and_changes_nothing(spark, stored):
    batch = spark.createDataFrame([("k1", 7, "", 1)], "id string, v long, note string, seq int")

    def step(old, new):
        keyed.upsert_into(spark.createDataFrame([("k2", 9, "", 1)], "id string, v long, note string, seq int"), stored, order="seq")
        return old.withColumn("v", F.col("v") + 1).withColumn("change", F.lit("updated"))

    with pytest.raises(RuntimeError, match="another writer"):
        keyed.merge(batch, stored, step)
    assert rows(keyed.read(spark, stored).where("id in ('k1', 'k2')")) == [("k1", 1, ""), ("k2", 9, "")]


def test_changes_read_only_buckets_that_differ(spark, stored):
    batch = spark.createDataFrame([("k1", 7, "", 1), ("new", 8, "n", 1)], "id string, v long, note string, seq int")
    keyed.upsert_into(batch, stored, order="seq")
    found = keyed.changes(spark, stored, 1, 2)
    assert sorted((r.id, r.change, r.old.v if r.old else None, r.new.v) for r in found.collect()) == [("k1", "updated", 1, 7), ("new", "created", None, 8)]
    assert len(found.inputFiles()) <= 4
    assert keyed.changes(spark, stored, 2, 2).count() == 0 and keyed.changes(spark, stored, 2, 1).where("change = 'deleted'").count() == 1


def test_accretion_into_a_stored_table(spark, tmp_path):
    path = f"{tmp_path}/e"
    keyed.create(spark.createDataFrame([("e1", ["u1"], ["o1"], "first"), ("e2", ["u2"], [], "second")], "event_id string, source_urls array<string>, source_outlets array<string>, headline string"), path, key="event_id", buckets=4)
    add = spark.createDataFrame([("e1", ["u1", "u3"], ["o2"], "new"), ("e1", ["u4"], ["o1"], "new"), ("e9", ["u9"], [], "x")], "event_id string, source_urls array<string>, source_outlets array<string>, headline string")
    assert keyed.accrete_into(add, path)["updated"] == 1
    assert rows(keyed.read(spark, path)) == [("e1", ["u1", "u3", "u4"], ["o1", "o2"], "first"), ("e2", ["u2"], [], "second")]
    assert "updated" not in keyed.accrete_into(add, path) and keyed.number(spark, path) == 2
    assert keyed.accrete_into(add, path, regenerated=["headline"])["updated"] == 1
    assert keyed.read(spark, path).where("event_id = 'e1'").first().headline == "new"


def test_snapshot_after_a_writer_that_died(spark, tmp_path):
    path = f"{tmp_path}/s"
    with pytest.raises(FileNotFoundError):
        tables.read_snapshot(spark, path)
    tables.write_snapshot(spark.range(3), path)
    (Path(path) / "_current" / f"{2:012d}").touch()
    assert tables.snapshot_number(spark, path) == 1 and tables.read_snapshot(spark, path).count() == 3
    tables.write_snapshot(spark.range(5), path, after=1)
    assert tables.snapshot_number(spark, path) == 3 and tables.read_snapshot(spark, path).count() == 5
