"""Groups and keys that hold all rows: equal to the plain form, with no task that holds them all; deep pages; rebuilds."""

import datetime
import random
from pathlib import Path

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from actionwatch.functions.text import name_variants
from actionwatch.operators import filters, joins, lifecycle, ranking
from actionwatch.sources import dated, tables, versions


@pytest.fixture
def wide(spark):
    """Many partitions, so that a range is a small part."""
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("groups", [1, 3, 500])
def test_places_in_a_group_of_all_rows(spark, wide, groups, monkeypatch):
    df = spark.range(4000).select((F.col("id") % groups).alias("g"), F.when(F.col("id") % 7 > 0, F.col("id") * 7919 % 1009).alias("v"), F.col("id").alias("range"), F.lit("x").alias("shift"))
    df = df.withColumn("g", F.when(F.col("g") != 1, F.col("g")))
    order = [F.desc("v"), F.asc("range")]
    most, dealt = [], ranking._dealt

    def counted(*a):
        out = dealt(*a)
        most.append(max((r["count"] for r in out.groupBy(a[3]).count().collect()), default=0))
        return out

    monkeypatch.setattr(ranking, "_dealt", counted)
    got = ranking.placed_in_group(df, group=["g"], order=order)
    assert got.columns == [*df.columns, "rank"] and most[0] < 1000
    assert rows(got) == rows(df.withColumn("rank", F.row_number().over(Window.partitionBy("g").orderBy(*order))))
    assert ranking.placed_in_group(df.limit(0), group=["g"], order=order).count() == 0


def test_sliding_counts_of_one_hot_key(spark, wide):
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 7 % 30_000)
    df = spark.range(3000).select(F.lit("k").alias("key"), F.when(F.col("id") % 50 > 0, at).alias("ts"), F.col("id").alias("piece"), F.lit(1).alias("own"))
    df = df.unionByName(df.where("piece < 100").withColumn("key", F.lit(None).cast("string")))
    got = ranking.sliding_count(df, key="key", ts="ts", seconds=60, most=3)
    w = Window.partitionBy("key").orderBy(F.unix_micros("ts")).rangeBetween(-60_000_000 + 1, 0)
    want = df.withColumn("attempts", F.count(F.lit(1)).over(w)).withColumn("limited", F.col("attempts") > 3)
    assert got.columns == want.columns and rows(got) == rows(want)
    held = got.withColumn("p", F.spark_partition_id()).groupBy("p").count().agg(F.max("count")).first()[0]
    assert held < 1000


def test_a_deep_page_reads_one_range(spark, wide):
    df = spark.range(5003).select((F.col("id") * 7919 % 1013).alias("v"), "id", F.lit("r").alias("range"))
    order = [F.desc("v"), F.asc("id")]
    pages = ranking.Pages(df, order=order)
    for n in (-3, 1, 2, 77, 400, 501, 10_000):
        assert pages.page(n).collect() == ranking.page(df, order=order, number=n).collect()
    assert pages.page(400).select("page", "pages").distinct().collect() == [(400, 501)]
    assert len({f.rpartition("/")[0] for f in pages.page(400).inputFiles()}) <= 2 < len(pages.ranges)
    assert pages.page(3, size=2000).count() == 1003
    assert ranking.Pages(df.limit(0), order=order).page(1).count() == 0


def forms_of(name):
    """As the rule says: the name, without single letters, first and last."""
    words = name.split()
    import re

    kept = [w for w in words if not re.fullmatch(r"[A-Za-z]\.?", w)]
    out = [" ".join(words), " ".join(kept)] + ([f"{kept[0]} {kept[-1]}"] if len(kept) > 2 else [])
    return list(dict.fromkeys(x for x in out if x))


def test_names_of_any_length(spark):
    import re

    rnd = random.Random(3)
    pool = ["Ann", "Lee", "de", "la", "Cruz", "y", "Lopez", "B.", "j", "Maria", "Zoë", "O'Neil", "Van", "der", "Berg", "K"]
    names = ["Maria de la Cruz y Lopez", "Ann Lee J.", "Cher", "j. k. Lee", "Ann  B. Lee", "", None, "B.", *(" ".join(rnd.choice(pool) for _ in range(rnd.randint(1, 8))) for _ in range(60))]
    plain = lambda s: [w for w in re.sub(r"[^\w']+|_", " ", (s or "").lower()).split(" ") if w]
    texts = [None, "", "Cher!", *(" ".join(rnd.choice([*pool, "said", "the", "and,", "MARIA"]) for _ in range(rnd.randint(0, 25))) for _ in range(150)), "then Maria de la Cruz y Lopez, ANN LEE; cher"]
    roster = spark.createDataFrame(list(enumerate(names)), "id long, name string")
    articles = spark.createDataFrame(list(enumerate(texts)), "a long, text string")
    assert {r.id: r.f for r in roster.where("name is not null").select("id", name_variants(F.col("name")).alias("f")).collect()} == {i: forms_of(n) for i, n in enumerate(names) if n is not None}
    want = set()
    for a, t in enumerate(texts):
        line = f" {' '.join(plain(t))} "
        for i, n in enumerate(names):
            if any(plain(f) and f" {' '.join(plain(f))} " in line for f in forms_of(n or "")):
                want.add((a, i))
    got = [tuple(r) for r in joins.match_names(articles, roster, key="a", text="text", candidate="id", name="name").collect()]
    assert len(got) == len(set(got)) and set(got) == want and (len(texts) - 1, 0) in want and (len(texts) - 1, 1) in want and (2, 2) in want


def test_repeated_keys_do_not_multiply_rows(spark):
    items = spark.createDataFrame([(1,), (2,), (3,)], "item_id long")
    verdicts = spark.createDataFrame([(1, True, ["digital"], None), (1, False, [], "no"), (2, False, [], "b"), (2, False, [], "a"), (None, True, [], None)], "item_id long, pass boolean, pillars array<string>, reason string")
    got = {r.item_id: (r.kept, r.drop_reason) for r in filters.verdict_gate(items, verdicts, key="item_id", choices=["digital"]).collect()}
    assert got == {1: (True, None), 2: (False, "b"), 3: (False, "error")}

    events = spark.createDataFrame([(1, ["x"], 1, "old", "t", ["a"], "w"), (2, ["x"], 1, "old", "t", ["a"], "w"), (3, ["x"], 1, None, "t", ["a"], "w")], "id long, competency array<string>, relevance int, agenda string, short_title string, topic_tags array<string>, why_it_matters string")
    v = spark.createDataFrame([(1, ["digital"], "3", "new", "", ["b", "odd"], None), (1, ["digital"], "2", "other", "", [], "x"), (3, ["bad"], "3", "", "s" * 200, None, "why")], "id long, competencies array<string>, relevance string, summary string, short_title string, topic_tags array<string>, why_it_matters string")
    got = rows(lifecycle.apply_verdict(events, v, key="id", choices=["digital"], tags=["a", "b"], summary="agenda"))
    assert got == [(1, ["digital"], 3, "new", "t", ["b"], ""), (2, ["x"], 1, "old", "t", ["a"], "w"), (3, [], None, "", "s" * 160, [], "why")]
    # Source types grow with the other lists.
    stored = spark.createDataFrame([("e", ["u"], ["o"], ["news"])], "event_id string, source_urls array<string>, source_outlets array<string>, source_types array<string>")
    add = spark.createDataFrame([("e", ["u", "v"], ["p"], ["agency"])], stored.schema)
    assert rows(lifecycle.accrete(stored, add)) == [("e", ["u", "v"], ["o", "p"], ["news", "agency"], 1)]

    old = spark.createDataFrame([("A", "p", "s")], "candidate string, party string, status string")
    seed = spark.createDataFrame([("A", "q"), ("A", ""), ("A", None), ("B", "r"), ("B", "r")], "candidate string, party string")
    assert rows(lifecycle.seed_roster(old, seed, keys=["candidate"], owned=["party"])) == [("A", "q", "s"), ("B", "r", None)]

    people = spark.createDataFrame([("a@b.c", "active", 1), ("A@b.c ", "active", 2), ("bad", "active", 3), (None, "active", 4), ("bad", "off", 5)], "email string, status string, seq int")
    assert lifecycle.malformed_recipients(people).first()[0] == 2 and rows(lifecycle.active_recipients(people)) == [("a@b.c", 1)]


def test_rebuild_keeps_files_before_the_floor_and_other_states(spark, tmp_path):
    path = f"{tmp_path}/clean"
    day = lambda k: datetime.date(2024, 1, k) if k else None
    clean = spark.createDataFrame([(i, s, day(k)) for i, (s, k) in enumerate([("A", 1), ("B", 1), ("A", 5), ("B", 5), ("A", 6), ("B", 7), ("A", 0), ("B", 0), (None, 6)])], "id long, state string, date date")
    dated.create(clean, path)
    before = versions.load(spark, path)[1]["folders"]
    new = spark.createDataFrame([(100, "A", day(5)), (101, "A", day(2)), (102, "B", day(6)), (103, "A", None), (104, "A", day(9))], "id long, state string, date date")
    dated.rebuild(new, path, floor=day(5), scope=F.col("state") == "A")
    assert {r.id for r in dated.read(spark, path).collect()} == {0, 1, 3, 5, 6, 7, 8, 100, 104}
    after = versions.load(spark, path)[1]["folders"]
    same = {k for k in before if before[k] == after.get(k)}
    number = lambda k: str((day(k) - datetime.date(1970, 1, 1)).days)
    assert same == {number(1), number(7), str(dated.UNDATED)}
    dated.rebuild(new, path, floor=day(5))
    assert {r.id for r in dated.read(spark, path).collect()} == {0, 1, 6, 7, 100, 102, 104}
    assert {r.id for r in dated.read(spark, path, version=1).collect()} == set(range(9))


def test_context_of_triggered_groups_reads_their_buckets(spark, tmp_path):
    path = f"{tmp_path}/raw"
    df = spark.range(600).select(F.col("id").alias("row_id"), (F.col("id") % 40).cast("string").alias("grp"), F.concat(F.lit("u"), "id").alias("url"), F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 3600).alias("ingested_at"))
    tables.append_raw(df, path, group="grp", buckets=32)
    raw = spark.read.parquet(path)
    seen = df.where("grp <> '7'").select("url")
    pruned = lifecycle.trigger_and_context(raw, seen, group="grp", as_of="2024-01-26", trigger_days=2, bucket="group_bucket")
    plain = lifecycle.trigger_and_context(raw, seen, group="grp", as_of="2024-01-26", trigger_days=2)
    assert rows(pruned.select("row_id")) == rows(plain.select("row_id")) and pruned.count() > 10
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(group_bucket" in plan or "group_bucket#" in plan.split("PartitionFilters")[1].split("]")[0]
    assert len({Path(f).parents[1].name for f in spark.read.parquet(path).where(F.col("group_bucket").isin([r[0] for r in raw.where("grp = '7'").select("group_bucket").distinct().collect()])).inputFiles()}) >= 1


def test_words_of_very_many_articles_are_dealt_into_parts(spark, monkeypatch):
    monkeypatch.setattr(joins, "WORD_ROWS", 20)
    roster = spark.range(200).select("id", F.concat(F.lit("Maria Cruz N"), "id").alias("name")).unionByName(spark.createDataFrame([(900, "Maria"), (901, "Cruz")], "id long, name string"))
    articles = spark.range(400).select(F.col("id").alias("a"), F.concat(F.lit("Today MARIA Cruz N"), F.col("id") % 250, F.lit(" spoke")).alias("text"))
    most, deal = [], joins._dealt

    def counted(*a):
        out = deal(*a)
        most.append(out[0].groupBy("word", "part").count().agg(F.max("count")).first()[0])
        return out

    monkeypatch.setattr(joins, "_dealt", counted)
    got = rows(joins.match_names(articles, roster, key="a", text="text", candidate="id", name="name"))
    want = [(a, i) for a in range(400) for i in [a % 250, 900, 901] if i < 200 or i >= 900]
    assert got == sorted(want, key=str) and len(most) == 2 and max(most) < 60
