import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from actionwatch.operators import aggregates, filters, joins, lifecycle, ranking, shared
from actionwatch.operators.clustering import cluster, components
from actionwatch.plans import ranking as plans
from actionwatch.plans.registry import QUERIES
from actionwatch.sources import tables


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_date_gates(spark):
    df = spark.sql("select * from values (1, date'2024-01-31'), (2, date'2024-01-21'), (3, date'2024-01-20'), (4, cast(null as date)) as t(id, d)")
    assert rows(filters.date_gate(df, date="d", as_of="2024-01-31", days=10).select("id")) == [(1,), (2,)]
    assert rows(filters.date_gate(df, date="d", as_of="2024-01-31", days=10, keep_undated=True).select("id")) == [(1,), (2,), (4,)]
    assert rows(filters.half_open(df, date="d", as_of="2024-01-31", days=10).select("id")) == [(2,)]


def test_verdict_gate(spark):
    items = spark.range(5).withColumnRenamed("id", "item_id")
    verdicts = spark.sql("select * from values (0L, true, array('x', 'a'), ''), (1L, true, array('x'), ''), (2L, false, array('a'), 'dull'), (3L, false, array('a'), '') as t(item_id, pass, pillars, reason)")
    got = rows(filters.verdict_gate(items, verdicts, key="item_id", choices=["a"]).select("item_id", "drop_reason", "kept"))
    assert got == [(0, None, True), (1, "no valid category", False), (2, "dull", False), (3, "rejected", False), (4, "error", False)]


def test_bill_status_order(spark):
    texts = ["Passed Senate; passed House", "Passed Senate", "Became Public Law", "Referred to the Committee", "", None]
    got = [r.s for r in spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string").select("i", filters.bill_status(F.col("x")).alias("s")).orderBy("i").collect()]
    assert got == ["passed-both", "passed-chamber", "enacted", "in-committee", "introduced", "introduced"]


def test_upsert_and_idempotence(spark):
    old = spark.sql("select * from values ('a', 'x', ''), ('b', 'y', 'checked'), ('c', 'z', '') as t(id, v, note)")
    batch = spark.sql("select * from values ('a', 1, 'x', ''), ('b', 1, 'new', 'other'), ('d', 1, 'one', ''), ('d', 2, 'two', ''), ('', 3, 'skip', ''), (null, 4, 'skip', '') as t(id, seq, v, note)")
    once = lifecycle.upsert(old, batch, key="id", order="seq", preserve=["note"])
    assert rows(once) == [("a", "x", "", "unchanged"), ("b", "new", "checked", "updated"), ("c", "z", "", "unchanged"), ("d", "two", "", "created")]
    again = lifecycle.upsert(once.drop("change"), batch, key="id", order="seq", preserve=["note"])
    assert {r.change for r in again.collect()} == {"unchanged"}


def test_accretion_only_grows(spark):
    events = spark.sql("select * from values ('e1', array('u1'), array('o1'), 'frozen'), ('e2', array('u2'), array('o2'), 'frozen') as t(event_id, source_urls, source_outlets, headline)")
    more = spark.sql("select * from values ('e1', array('u1', 'u9'), array('o9'), 'changed') as t(event_id, source_urls, source_outlets, headline)")
    got = rows(lifecycle.accrete(events, more))
    assert got == [("e1", ["u1", "u9"], ["o1", "o9"], "frozen", 1), ("e2", ["u2"], ["o2"], "frozen", 0)]
    assert rows(lifecycle.accrete(events, more, regenerated=["headline"]).select("event_id", "headline")) == [("e1", "changed"), ("e2", "frozen")]


def test_group_key_is_order_free(spark):
    df = spark.sql("select * from values (1, array('gao', 'opm')), (2, array('opm', 'gao')), (3, array('gao')), (4, cast(array() as array<string>)) as t(id, a)")
    assert rows(df.select("id", lifecycle.agency_group(F.col("a"), ["gao"]))) == [(1, "opm"), (2, "opm"), (3, "gao"), (4, "(unattributed)")]


def test_prune_reports_reviewed(spark):
    events = spark.sql("select * from values ('a', array('u1'), 'unreviewed'), ('b', array('u1', 'u2'), ''), ('c', array('u2', 'u3'), 'confirmed'), ('d', array('u1'), 'confirmed') as t(event_id, source_urls, review_status)")
    inside = joins.all_contained(events, spark.sql("select * from values 'u1', 'u2' as t(url)"))
    got = rows(lifecycle.prune(events, spark.sql("select 'b' as event_id"), inside).select("event_id", "action"))
    assert got == [("a", "delete"), ("d", "report")]


def test_owner_choice(spark):
    clusters = spark.sql("select 'c' as cluster_id, array('u1', 'u2', 'u3') as source_urls")
    events = spark.sql("select * from values ('e1', null, 1, array('u1')), ('e2', date'2024-01-02', 2, array('u2', 'u3')), ('e3', date'2024-01-02', 3, array('u2')) as t(event_id, date, seq, source_urls)")
    got = ranking.choose_owner(joins.match_owners(clusters, events)).first()
    assert (got.event_id, got.shared, got.candidates) == ("e2", 2, 2)  # u2 belongs to e2, stored first


def test_blank_urls_are_never_merged(spark):
    df = spark.sql("select * from values (1, 'u'), (2, 'u'), (3, ''), (4, ''), (5, null) as t(seq, url)")
    assert rows(ranking.keep_first_url(df).select("seq")) == [(1,), (3,), (4,), (5,)]


def test_sliding_count_window_is_open(spark):
    df = spark.sql("select * from values (1, timestamp'2024-01-01 00:00:00'), (2, timestamp'2024-01-01 00:00:59'), (3, timestamp'2024-01-01 00:01:00') as t(id, ts)").withColumn("k", F.lit(1))
    assert rows(ranking.sliding_count(df, key="k", ts="ts", most=1).select("id", "attempts", "limited")) == [(1, 1, False), (2, 2, True), (3, 2, True)]


def test_page_clamps(spark):
    df = spark.range(25)
    assert [r.id for r in ranking.page(df, order=[F.asc("id")], number=9).collect()] == [20, 21, 22, 23, 24]
    assert [r.id for r in ranking.page(df, order=[F.asc("id")], number=-1).collect()][:2] == [0, 1]
    assert ranking.page(df.where("id < 0"), order=[F.asc("id")], number=1).count() == 0
    assert ranking.page_links(5, 9) == [1, None, 4, 5, 6, None, 9]


def test_places_have_no_cap(spark, monkeypatch):
    n = 1_000_002
    roster = spark.range(n).select(F.lit("S1").alias("state"), F.col("id").alias("candidate"), F.lit("D").alias("party"), F.lit("running").alias("status"))
    monkeypatch.setattr(plans.fx, "roster", lambda t: roster)
    got = QUERIES["WIN-15"](None).agg(F.count("place"), F.max("place")).first()
    assert tuple(got) == (n, n)


def test_facets_without_choice(spark):
    df = spark.sql("select * from values (1, array('a')), (2, cast(array() as array<string>)) as t(id, competency)")
    assert rows(filters.facets(df, categories=[], empty_shows_all=True).select("id")) == [(1,)]
    assert rows(filters.facets(df, categories=[]).select("id")) == []
    assert rows(filters.facets(df, categories=["a"], show_uncategorised=True).select("id")) == [(1,), (2,)]


def test_human_merge(spark):
    events = spark.sql("select * from values ('a', date'2024-01-02', array('u1'), ''), ('b', date'2024-01-01', array('u2', 'u1'), ''), ('c', null, array('u3'), 'checked') as t(event_id, date, source_urls, review_status)")
    groups = spark.sql("select * from values (1, 'a'), (1, 'b'), (1, 'c'), (2, 'a'), (2, 'zz') as t(group_no, event_id)")
    got = {r.group_no: r for r in lifecycle.human_merge(events, groups).collect()}
    assert (got[1].survivor, got[1].source_urls, got[1].review_status, got[1].bad) == ("b", ["u2", "u1", "u3"], "checked", False)
    assert got[2].bad


def test_parties_and_ranks(spark):
    df = spark.sql("select * from values (1, 'majority', 'low'), (1, 'member', 'high'), (2, 'minority', 'odd'), (3, '', 'low') as t(g, p, v)")
    got = rows(df.groupBy("g").agg(aggregates.merged_party("p"), aggregates.highest("v", ["low", "high"], "none")))
    assert got == [(1, "member", "high"), (2, "minority", "none"), (3, "majority", "low")]


def test_cluster_finds_near_copies(spark):
    base = " ".join(f"w{i}" for i in range(60))
    near, far = base.replace("w30", "other"), " ".join(f"v{i}" for i in range(60))
    df = spark.createDataFrame([("g", 1, base), ("g", 2, near), ("g", 3, far), ("h", 4, base), ("g", 5, ""), ("g", 6, None), ("g", 7, base)], "grp string, id long, text string")
    got = {r.id: r.cluster for r in cluster(df, group="grp", row="id", text="text").collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 6, 7: 1}


def clustered_as_brute_force(spark, texts):
    sets = [{tuple(w[i : i + 3]) for i in range(len(w) - 2)} for w in map(str.split, texts)]
    want = list(range(len(texts)))
    for b in range(len(texts)):
        for a in range(b):
            common = len(sets[a] & sets[b])
            if 10 * common >= 7 * (len(sets[a]) + len(sets[b]) - common) and want[a] != want[b]:
                low, high = sorted((want[a], want[b]))
                want = [low if x == high else x for x in want]
    df = spark.createDataFrame([("g", i, t) for i, t in enumerate(texts)], "grp string, id long, text string")
    got = {r.id: r.cluster for r in cluster(df, group="grp", row="id", text="text").collect()}
    return got == dict(enumerate(want))


def test_cluster_compares_all_of_a_large_group(spark):
    """400 variants of one passage, around the threshold: their buckets hold far over 32 rows."""
    rnd = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    texts = [" ".join(f"x{rnd.random()}" if rnd.random() < 0.055 else w for w in base) for _ in range(400)]
    assert clustered_as_brute_force(spark, texts)


def test_cluster_of_many_dissimilar_texts_with_one_passage(spark):
    """Two thirds of each text are one passage: buckets of far over 32 texts, none of them near another."""
    passage = " ".join(f"w{i}" for i in range(120))
    assert clustered_as_brute_force(spark, [passage + "".join(f" x{n}-{i}" for i in range(60)) for n in range(300)])


def test_components_of_a_chain(spark):
    edges = spark.range(40).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    assert {r.component for r in components(edges).collect()} == {0}


def test_late_article_needs_context(spark):
    df = spark.sql("select * from values (1, 'g', 'u1', timestamp'2024-01-10'), (2, 'g', 'u2', timestamp'2024-01-30'), (3, 'h', 'u3', timestamp'2024-01-30') as t(row_id, grp, url, ingested_at)")
    seen = spark.sql("select * from values 'u1', 'u3' as t(url)")
    for days, want in ((16, [(2,)]), (30, [(1,), (2,)])):
        assert rows(lifecycle.trigger_and_context(df, seen, group="grp", as_of="2024-01-31", trigger_days=2, context_days=days).select("row_id")) == want


def test_snapshot_and_missing_table(spark, tmp_path):
    path = f"{tmp_path}/events"
    tables.write_snapshot(spark.range(3), path)
    tables.write_snapshot(tables.read_snapshot(spark, path).where("id > 0"), path)
    assert rows(tables.read_snapshot(spark, path)) == [(1,), (2,)]
    assert tables.read_table(spark, f"{tmp_path}/none", "id long").count() == 0


def test_rebuild_keeps_undated(spark):
    raw = spark.sql("select * from values (timestamp'2024-01-30', date'2024-01-05') as t(ingested_at, date)")
    floor = lifecycle.rebuild_floor(raw, as_of="2024-01-31", days=7)
    assert floor.first().floor == dt.date(2024, 1, 5)
    clean = spark.sql("select * from values (1, date'2024-01-04'), (2, date'2024-01-06'), (3, cast(null as date)) as t(id, date)")
    assert rows(lifecycle.rebuild(clean, spark.sql("select 9 as id, date'2024-01-07' as date"), floor).select("id")) == [(1,), (3,), (9,)]


def test_rows_without_an_order_are_not_lost(spark):
    old = spark.sql("select * from values ('a', 'x', 1L) as t(id, v, seq)")
    new = spark.sql("select * from values ('a', 'y', null), ('b', 'z', null), ('a', 'w', 3L) as t(id, v, seq)")
    assert sorted(map(tuple, lifecycle.upsert(old, new, key="id", order="seq").collect())) == [("a", "w", 3, "updated"), ("b", "z", None, "created")]
    urls = spark.sql("select * from values ('u', 7, null), ('v', 8, null), ('v', 9, 2) as t(url, row_id, seq)")
    assert sorted((r.url, r.row_id) for r in ranking.keep_first_url(urls).collect()) == [("u", 7), ("v", 9)]
    clusters = spark.sql("select 'c' as cluster_id, array('u') as source_urls")
    events = spark.sql("select 'e' as event_id, date'2024-01-01' as date, cast(null as int) as seq, array('u') as source_urls")
    assert joins.match_owners(clusters, events).first().event_id == "e"


def test_repeated_additions_are_one(spark):
    events = spark.sql("select 'e' as event_id, array('u1') as source_urls, array('o1') as source_outlets")
    more = spark.sql("select * from values ('e', array('u2'), array('o2')), ('e', array('u3', 'u1'), array('o3')) as t(event_id, source_urls, source_outlets)")
    assert [tuple(r) for r in lifecycle.accrete(events, more).collect()] == [("e", ["u1", "u2", "u3"], ["o1", "o2", "o3"], 2)]


def test_seed_keeps_types(spark):
    old = spark.sql("select * from values ('a', 5, 'x'), ('b', 6, 'y') as t(name, age, note)")
    seed = spark.sql("select * from values ('a', ' ', 'n'), ('b', '7', null), ('c', '8', 'm') as t(name, age, note)")
    out = lifecycle.seed_roster(old, seed, keys=["name"], owned=["age", "note"])
    assert dict(out.dtypes)["age"] == "int" and sorted(map(tuple, out.collect())) == [("a", 5, "n"), ("b", 7, "y"), ("c", 8, "m")]


def test_ranks_of_the_whole_table(spark):
    rows = spark.range(5000).select((F.col("id") * 37 % 5000).alias("id"), (F.col("id") % 7).alias("v"), F.lit("c").alias("place"))
    got = ranking.ranked(rows, order=[F.desc("v"), F.asc("id")]).orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 5001)) and [(-r.v, r.id) for r in got] == sorted((-r.v, r.id) for r in got)


def test_names_are_matched_by_phrase(spark):
    roster = spark.sql("select * from values (1, 'Ann B. Mae Lee'), (2, 'Bo Li'), (3, 'Solo') as t(id, name)")
    said = spark.sql("select * from values (10, 'Today ANN LEE and bo li.'), (11, 'Annlee; Bo, then Li Bo'), (12, null), (13, 'Solo') as t(a, text)")
    got = sorted(map(tuple, joins.match_names(said, roster, key="a", text="text", candidate="id", name="name").collect()))
    assert got == [(10, 1), (10, 2), (13, 3)]


def test_a_second_writer_of_one_version_raises(spark, tmp_path):
    path, df = f"{tmp_path}/t", spark.range(2)
    tables.write_snapshot(df, path)
    tables.write_snapshot(df.limit(1), path, after=1)
    with pytest.raises(RuntimeError, match="another writer"):
        tables.write_snapshot(spark.range(9), path, after=1)
    assert tables.snapshot_number(spark, path) == 2 and tables.read_snapshot(spark, path).count() == 1


def test_no_local_folder_on_a_cluster():
    class Conf:
        def __init__(self, **kv):
            self.kv = kv

        def get(self, key, default=None):
            return self.kv.get(key, default)

    class Session:
        def __init__(self, **kv):
            self.conf = Conf(**kv)

    with pytest.raises(ValueError, match="share"):
        shared.shared_folder(Session(**{"spark.master": "spark://h:7077"}))
    assert shared.shared_folder(Session(**{"spark.master": "spark://h:7077", "spark.checkpoint.dir": "s3a://x/"})) == "s3a://x"
    assert shared.shared_folder(Session(**{"spark.master": "local[4]"}))


def test_read_models_of_one_table_share_a_reading(spark):
    plan = __spark_entry__.queries()["SRC-14"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("get_json_object") == 1


def test_fields_of_read_models_are_those_of_each(spark):
    df = spark.sql("select * from values (1, '', 0, array('a', 'b')), (2, 'x', 3, array()), (3, null, null, null) as t(k, lane, n, tags)")
    given = {"lane": F.col("lane"), "relevance": F.col("n"), "topic_tags": F.col("tags"), "article_count": F.col("n")}
    models = {"events": {c: given[c] for c in ("relevance", "topic_tags", "article_count")}, "federal": given}
    got = {tuple(r) for r in tables.read_model_fields(df, F.col("k"), models).select("shape", "id", "field", "value").collect()}
    want = set()
    for shape, columns in models.items():
        for r in tables.read_model(df, shape, F.col("k"), columns).collect():
            want |= {(shape, r["id"], c, "|".join(r[c]) if isinstance(r[c], list) else str(r[c])) for c in tables.READ_MODELS[shape]}
    assert got == want
