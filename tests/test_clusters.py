"""Clusters over batches, and large families in one batch, against comparing all pairs."""

import random
from pathlib import Path

from pyspark.sql import functions as F

from actionwatch.operators.clustering import Bands, cluster
from actionwatch.sources import versions
from actionwatch.streaming import clusters


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w)} if len(w) <= 3 else {tuple(w[i : i + 3]) for i in range(len(w) - 2)}


def by_all_pairs(rows, threshold=0.7):
    """(group, id) -> least id connected."""
    found = {r[:2]: r[1] for r in rows}
    worded = [(g, i, shingles(t)) for g, i, t in rows if g is not None and i is not None and (t or "").split()]
    links = [((g, i), (h, j)) for k, (g, i, a) in enumerate(worded) for h, j, b in worded[:k] if g == h and len(a & b) >= threshold * len(a | b)]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(found[a], found[b])
            if found[a] != low or found[b] != low:
                found[a] = found[b] = low
                changed = True
    return found


def family(rnd, words, n, base=None):
    base = base or [f"w{rnd.randrange(5000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rnd.randint(0, words // 25)):
            w[rnd.randrange(words)] = f"x{rnd.randrange(9999)}"
        out.append(" ".join(w))
    return out


def test_large_families_give_the_same_clusters_in_small_blocks(spark):
    rnd = random.Random(4)
    passage = [f"p{i}" for i in range(30)]
    texts = family(rnd, 40, 60) + family(rnd, 60, 50) + [" ".join(passage + [f"o{rnd.randrange(9999)}" for _ in range(12)]) for _ in range(50)]
    rows = [("g", i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "grp string, id long, text string")
    want = by_all_pairs(rows)
    got = {(r.grp, r.id): r.cluster for r in cluster(df, group="grp", row="id", text="text", block=8).collect()}
    assert got == want and 3 < len(set(want.values())) < 160


def shuffled(spark, n):
    """Rows that the block stages of one family write."""
    rnd = random.Random(7)
    texts = family(rnd, 50, n)
    df = spark.createDataFrame([("g", i, t) for i, t in enumerate(texts)], "grp string, id long, text string")
    seen = []
    how = Bands(block=32, whole_blocks=0)

    class Counted(Bands):
        def links(self, placed, sketches, sets_of):
            from actionwatch.operators import clustering

            sizes = placed.groupBy("bucket", "band").agg(F.ceil(F.count_if("fresh") / self.block).cast("int").alias("blocks"), F.ceil(F.count_if(~F.col("fresh")) / self.block).cast("int").alias("others"), F.count(F.lit(1)).alias("n")).where("n > 1")
            seen.append(clustering._in_blocks(placed.join(sizes, ["bucket", "band"])).count())
            return super().links(placed, sketches, sets_of)

    from actionwatch.operators import clustering

    rows = clustering.keyed_texts(df, group="grp", row="id", text="text")
    sketches = how.sketch(rows, "grp", "id").groupBy("key").agg(F.first(F.xxhash64("grp")).alias("seed"), F.first("sig").alias("sig"))
    texts = rows.select("key", F.xxhash64("grp").alias("seed"), "words")
    links = Counted(block=32, whole_blocks=0).all_links(sketches, lambda needed: how.sets(texts.join(needed, "key", "left_semi")))
    assert clustering.components(links).select("component").distinct().count() == 1
    return sum(seen)


def test_rows_of_a_family_grow_with_its_size(spark):
    small, large = shuffled(spark, 128), shuffled(spark, 512)
    assert large < 6 * small, (small, large)


def test_whole_groups_give_the_clusters_of_bands(spark):
    """Groups of less than a block, of several blocks and of too many for a whole comparison, beside each other."""
    rnd = random.Random(11)
    sizes = {"one": 1, "few": 12, "blocks": 70, "many": 300}
    rows = [(g, 1000 * k + i, t) for k, (g, n) in enumerate(sizes.items()) for i, t in enumerate((family(rnd, 40, n // 2) + family(rnd, 40, n - n // 2)))]
    rows += [(g, 9000 + i, rows[0][2]) for i, g in enumerate(sizes)] + [("few", 9100, None)]
    df = spark.createDataFrame(rows, "grp string, id long, text string").repartition(5)
    found = [{r.id: r.cluster for r in cluster(df, group="grp", row="id", text="text", block=32, whole_blocks=w).collect()} for w in (0, 4, 100)]
    assert found[0] == found[1] == found[2] and len(found[0]) == len(rows)
    assert len({c for i, c in found[0].items() if 3000 <= i < 4000}) == 2 and found[0][9100] == 9100


def test_stream_gives_the_clusters_of_the_batch(spark, tmp_path):
    rnd = random.Random(9)
    path = f"{tmp_path}/state"
    a, b = [f"a{i}" for i in range(40)], [f"b{i}" for i in range(40)]
    texts = family(rnd, 40, 14, a) + family(rnd, 40, 12, b) + family(rnd, 30, 9) + [" ".join(rnd.sample(a + b, 30)) for _ in range(12)] + [None, " ", "one", "one", "ONE  "]
    rows = [(rnd.choice(["g", "g", "h"]), i, t) for i, t in enumerate(texts)] + [(None, 900, texts[0]), ("g", 901, texts[0])]
    nameless = ("g", None, texts[0])
    rnd.shuffle(rows)
    write = clusters.grow(path, group="grp", row="id", text="text", parts=8)
    ids = {}
    third = -(-len(rows) // 3)
    for k in range(3):
        part = rows[k * third : (k + 1) * third]
        df = spark.createDataFrame([(*r, "extra") for r in [*part, nameless]], "grp string, id long, text string, key string")
        write(df, k)
        before = versions.load(spark, path)[0]
        write(df, k)  # a repeated batch writes no version
        assert versions.load(spark, path)[0] == before == k + 1
        sofar = rows[: (k + 1) * third]
        got = clusters.read_clusters(spark, path).collect()
        # A row without an id is new in every batch, but not in a repeated one.
        assert sum(r.id is None for r in got) == k + 1
        got = [r for r in got if r.id is not None]
        assert len(got) == len(sofar) and {(r.grp, r.id): r.cluster for r in got} == by_all_pairs(sofar)
        now = {(r.grp, r.id): r.event_id for r in got if r.event_id}
        taken = {i for r in clusters.read_events(spark, path).collect() for i in r.superseded}
        assert all(now[x] == old or old in taken for x, old in ids.items())
        ids = now


def test_a_late_text_joins_two_events(spark, tmp_path):
    path = f"{tmp_path}/state"
    w = [f"w{i}" for i in range(60)]
    rows = [("g", 1, " ".join(w[:46])), ("g", 2, " ".join(w[14:])), ("h", 3, "quite another text of some words here")]
    link = ("g", 4, " ".join(w[4:56]))
    write = clusters.grow(path, group="grp", row="id", text="text", url="url", parts=64)
    land = lambda rs: spark.createDataFrame([(*r, f"https://x.example/{r[1]}") for r in rs], "grp string, id long, text string, url string")
    write(land(rows[:1]), 0)
    write(land(rows[1:]), 1)
    first = {r.id: r.event_id for r in clusters.read_clusters(spark, path).collect()}
    assert len(set(first.values())) == 3
    write(land([link]), 2)
    got = {r.id: (r.cluster, r.event_id) for r in clusters.read_clusters(spark, path).collect()}
    assert got == {1: (1, first[1]), 2: (1, first[1]), 4: (1, first[1]), 3: (3, first[3])}
    assert [r.superseded for r in clusters.read_events(spark, path).collect() if r.event_id == first[1]] == [[first[2]]]


def test_a_batch_reads_only_the_parts_it_hits(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/state"
    write = clusters.grow(path, group="grp", row="id", text="text", parts=4096)
    rnd = random.Random(1)
    land = lambda rs: spark.createDataFrame(rs, "grp string, id long, text string")
    write(land([("g", i, " ".join(f"w{rnd.randrange(10**6)}" for _ in range(20))) for i in range(20)]), 0)
    read, get = [], versions.get
    monkeypatch.setattr(versions, "get", lambda s, p, folders, schema, parts=None: read.append((schema, parts, len(folders))) or get(s, p, folders, schema, parts))
    write(land([("g", 100, "a text that has nothing in common with those before it")]), 1)
    bands = [x for x in read if x[0] == clusters.BANDS]
    assert len(bands) == 1 and len(bands[0][1]) <= 64 and bands[0][2] > 600
    sets = [x for x in read if x[0] == clusters.SETS]
    assert sets[0][1] == set()
    assert Path(path, versions.FOLDER).exists()


def test_bits_leave_only_similar_texts_of_a_bucket():
    """Texts that share a bucket by chance need no signatures; two stored texts are not compared; blocks meet in pairs."""
    import numpy as np
    import pyarrow as pa

    from actionwatch.operators import clustering

    rnd = np.random.RandomState(5)
    sig = rnd.randint(0, 256, (400, 256)).astype(np.uint8)
    sig[[7, 350]] = sig[3]
    sig[7, :60] ^= 1  # 196 of 256 bits agree with rows 3 and 350, about what a pair at 0.7 has less one deviation
    sig[20] = sig[21]
    block = np.repeat([0, 1], 200)
    fresh = np.ones(400, bool)
    fresh[[20, 21]] = False

    def left(i, j, block):
        names = ["bucket", "i", "j", "band", "block", "key", "fresh", "bits"]
        n = len(sig)
        full = lambda v: pa.array(np.full(n, v))
        bits = pa.array([x.tobytes() for x in clustering.packed(sig)], pa.binary())
        batch = pa.RecordBatch.from_arrays([full(9), full(i), full(j), full(0), pa.array(block), pa.array([str(k).encode() for k in range(n)]), pa.array(fresh), bits], names)
        made = clustering._near(256, 0.7)([batch.slice(k, 90) for k in range(0, n, 90)])
        return sorted(int(k) for b in made for k in b.column("key").to_pylist())

    assert left(0, 0, np.zeros(400, int)) == [3, 7, 350]
    assert left(0, 1, block) == [3, 7, 350]
