from pyspark.sql import functions as F

from actionwatch.operators import udf
from actionwatch.sources.tables import read_snapshot, snapshot_number, write_snapshot
from actionwatch.streaming import stream

SCHEMA = "row_id long, url string, ingested_at timestamp"


def land(spark, path, values):
    spark.createDataFrame(values, "row_id long, url string, at string").select("row_id", "url", F.to_timestamp("at").alias("ingested_at")).coalesce(1).write.mode("append").parquet(path)


def test_restart_takes_only_new_files(spark, tmp_path):
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(SCHEMA)
    landing, out, progress = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/progress"
    land(spark, landing, [(1, "u1", "2024-01-01"), (2, "u1", "2024-01-01"), (3, "u2", "2024-01-02")])
    for _ in range(2):
        fresh = stream.first_seen(stream.landed(spark, landing, schema)).select("url")
        stream.run(fresh, progress, each=stream.append_unseen(out))
        assert sorted(r.url for r in spark.read.parquet(out).collect()) == ["u1", "u2"]
    land(spark, landing, [(4, "u2", "2024-01-03"), (5, "u3", "2024-01-03")])
    stream.run(stream.first_seen(stream.landed(spark, landing, schema)).select("url"), progress, each=stream.append_unseen(out))
    assert sorted(r.url for r in spark.read.parquet(out).collect()) == ["u1", "u2", "u3"]


def test_unchanged_batch_writes_no_version(spark, tmp_path):
    path = f"{tmp_path}/table"
    write_snapshot(spark.sql("select * from values ('a', 'x'), ('b', 'y') as t(id, v)"), path)
    write = stream.upsert_batches(path, key="id", order="seq")
    write(spark.sql("select 'a' as id, 1 as seq, 'x' as v"), 0)
    assert snapshot_number(spark, path) == 1
    write(spark.sql("select 'a' as id, 1 as seq, 'z' as v"), 1)
    assert snapshot_number(spark, path) == 2
    assert sorted(map(tuple, read_snapshot(spark, path).collect())) == [("a", "z"), ("b", "y")]


def test_rate_limit_state_spans_batches(spark, tmp_path):
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(SCHEMA)
    landing, out = f"{tmp_path}/in", f"{tmp_path}/out"
    land(spark, landing, [(1, "k", "2024-01-01 00:00:00"), (2, "k", "2024-01-01 00:00:10")])
    progress = f"{tmp_path}/progress"
    for values in ([(3, "k", "2024-01-01 00:00:50"), (4, "k", "2024-01-01 00:01:00")], None):
        rows = stream.rate_limits(stream.landed(spark, landing, schema), key="url", id_column="row_id", ts="ingested_at", seconds=60, most=2)
        stream.run(rows, progress, path=out)
        if values:
            land(spark, landing, values)
    got = sorted((r.id, r.attempts, r.limited) for r in spark.read.parquet(out).collect())
    assert got == [(1, 1, False), (2, 2, False), (3, 3, True), (4, 3, True)]


def test_failures_stay_with_their_row(spark):
    def scorer(row):
        return {"passed": 10 // row["n"] > 2}

    df = spark.createDataFrame([(1, 2), (2, 0), (3, 9)], "id long, n long")
    got = {r.id: (r.passed, r.error) for r in udf.score_rows(df, scorer, key="id", result="passed boolean").collect()}
    assert got[1] == (True, None) and got[3] == (False, None)
    assert got[2][0] is None and got[2][1].startswith("ZeroDivisionError")


def test_rate_limit_state_ends_with_the_window(spark, tmp_path):
    """Times of a silent key leave the state once the watermark has passed their window."""
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(SCHEMA)
    landing, out, progress = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/progress"
    held = []
    for values in ([(k, f"key{k}", "2024-01-01 00:00:00") for k in range(20)], [(50, "late", "2024-01-01 05:00:00")], [(51, "late", "2024-01-01 05:00:01")]):
        land(spark, landing, values)
        rows = stream.rate_limits(stream.landed(spark, landing, schema), key="url", id_column="row_id", ts="ingested_at", seconds=60, most=2)
        stream.run(rows, progress, path=out)
        state = spark.read.format("statestore").option("stateVarName", "times").option("flattenCollectionTypes", "true").load(progress)
        held.append({r.key.key for r in state.select("key").collect()})
    assert len(held[0]) == 20 and held[-1] == {"late"}
    assert spark.read.parquet(out).count() == 22
