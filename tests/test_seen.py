"""The index of seen URLs: exact answers, parts read, replays."""

from pathlib import Path

from pyspark.sql import functions as F

from actionwatch.sources import seen, versions
from actionwatch.streaming import stream


def urls(spark, *ids):
    return spark.createDataFrame([(i if not isinstance(i, int) else f"https://x.example/{i}",) for i in ids], "url string")


def test_answers_are_exact_over_generations(spark, tmp_path):
    path = f"{tmp_path}/seen"
    assert seen.unseen(urls(spark, 1, None), path).count() == 2
    for k in range(5):
        seen.append(spark.range(400 * k, 400 * k + 300).select(F.concat(F.lit("https://x.example/"), "id").alias("url")), path, parts=8)
    items = spark.range(2400).select(F.concat(F.lit("https://x.example/"), "id").alias("url"), "id").unionByName(spark.sql("select '' as url, 1L as id union all select ' ', 2L union all select null, 3L"))
    got = {r.id for r in seen.unseen(items, path).where("id > 3").collect()}
    assert got == {i for i in range(4, 2400) if i >= 2000 or i % 400 >= 300}
    assert seen.unseen(items, path).where("url is null or trim(url) = ''").count() == 3


def test_generations_stay_few_and_parts_are_pruned(spark, tmp_path):
    path = f"{tmp_path}/seen"
    for k in range(6):
        seen.append(spark.range(100 * k, 100 * k + 100).select(F.concat(F.lit("https://x.example/"), "id").alias("url")), path, parts=16)
    _, m = versions.load(spark, path)
    assert len(m["generations"]) <= 3 and sum(g["urls"] for g in m["generations"]) == 600
    # One URL that is known: only its part is read.
    one = urls(spark, 7, 10**9)
    found = seen.hits(one, path, m).collect()
    assert [r for r in found if r.url.endswith("/7")] and len(found) <= 2
    plan = seen.unseen(one, path)
    read = {f for f in plan.inputFiles() if "/seen/data/" in f}
    assert plan.count() == 1 and 1 <= len(read) <= 2
    assert len({f.partition("part=")[2].split("/")[0] for f in read}) == len(read)


def test_replay_adds_nothing_blank_urls_included(spark, tmp_path):
    path = f"{tmp_path}/t"
    write = stream.append_unseen(path, urls(spark, 5), parts=4)
    batch = urls(spark, 1, 2, 5, "", None, "")
    read = lambda: sorted(r.url or "-" for r in spark.read.parquet(path).collect())
    for _ in range(2):
        write(batch, 0)
        assert read() == ["-", "-", "-", "https://x.example/1", "https://x.example/2"]
    # Another batch may have blank URLs as well.
    write(urls(spark, 2, 3, ""), 1)
    assert read() == ["-"] * 4 + [f"https://x.example/{i}" for i in (1, 2, 3)]


def test_a_stream_keeps_all_rows_with_a_blank_url(spark, tmp_path):
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL("id long, url string, ingested_at timestamp")
    rows = [(1, "u1"), (2, "u1"), (3, ""), (4, None), (5, ""), (6, "u2")]
    spark.createDataFrame(rows, "id long, url string").withColumn("ingested_at", F.to_timestamp(F.lit("2024-01-01"))).write.parquet(f"{tmp_path}/in")
    out = f"{tmp_path}/out"
    stream.run(stream.first_seen(stream.landed(spark, f"{tmp_path}/in", schema)), f"{tmp_path}/progress", each=stream.append_unseen(out, parts=4))
    got = [r.id for r in spark.read.parquet(out).collect()]
    assert len(got) == 5 and {3, 4, 5, 6} < set(got)


def test_crash_between_rows_and_index(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    write = stream.append_unseen(path, parts=4)

    def die(*a, **b):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(seen, "append", die)
        try:
            write(urls(spark, 1, ""), 0)
        except KeyboardInterrupt:
            pass
    write(urls(spark, 1, ""), 0)
    write(urls(spark, 1, 2), 1)
    assert sorted(r.url for r in spark.read.parquet(path).collect()) == ["", "https://x.example/1", "https://x.example/2"]
    assert len(list(Path(path).glob("batch=*"))) == 2
