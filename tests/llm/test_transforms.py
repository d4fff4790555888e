"""Fill-in-middle, chat formatting and periodic runs against plain Python."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from actionwatch.llm import chat, fim, periodic, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UNIT = re.compile(r"(?s)[A-Za-z]+|[^A-Za-z]")
TEXTS = [None, "", " ", "word", "a b", "Zwei Wörter, 日本 😀😀 x1y\n\nend", "has <P> inside", "<S>", "cost $1 and \\$2 <M", "a" * 50_000, "ab " * 60_000, "é" * 30_000, "<P", "S><M", "\r\n\t"]


@pytest.fixture(scope="module")
def docs(spark):
    """Odd texts, repeated rows, and columns whose names the operators use inside."""
    rnd = random.Random(5)
    texts = [*TEXTS, *("".join(rnd.choice(["the ", "x", " ", "\n", "é", "😀", "<", "$", "9", "Aa"]) for _ in range(rnd.randint(0, 60))) for _ in range(200))]
    rows = [(i, t, "k", 1, 2) for i, t in enumerate(texts)] + [(4, texts[4], "k", 1, 2), (None, "no id here", "k", 1, 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, key string, n int, output int").repartition(3)


def cut(key, text, markers=("<P>", "<S>", "<M>")):
    digest = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = UNIT.findall(text)
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    p, s, m = markers
    if not text or any(x in text for x in markers) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(units), "spm", len(pre), len(mid), f"{s}{suf}{p}{pre}{m}{mid}"
    return len(units), "psm", len(pre), len(mid), f"{p}{pre}{s}{suf}{m}{mid}"


@pytest.mark.parametrize("markers", [("<P>", "<S>", "<M>"), ("$1\\", "[b", "(?s)c")])
def test_op11_cuts(docs, markers):
    out = fim.transform(docs, markers=markers).withColumn("back", fim.restore(F.col("output"), F.col("form"), markers))
    assert out.columns[:2] == ["doc_id", "text"]
    got = out.collect()
    assert len(got) == docs.count() and {r.form for r in got} == {"plain", "psm", "spm"}
    for r in got:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == cut(r.doc_id, r.text, markers)
        assert r.back == r.text


def test_op11_markers_must_not_overlap():
    for bad in (("<P>", "<P>", "<M>"), ("", "a", "b"), ("ab", "ba", "c"), ("aba", "x", "y"), ("abc", "b", "y")):
        with pytest.raises(ValueError):
            fim.check_markers(bad)


def test_op11_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert fim.transform(none).count() == 0


def test_op11_runs_in_generated_code(docs):
    plan = fim.transform(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan.split("== Physical Plan ==")[1].replace("Exchange RoundRobin", "")


CONTROL = [*chat.CONTROLS, r"<\turn>", r"<\\/turn>", "<", "</", "turn>", "\\", "says>", "\n", "x", "é😀", " "]


def made_chats(seed=2):
    rnd = random.Random(seed)
    rows = []
    for c in [*range(40), None]:
        for t in range(rnd.randint(1, 9)):
            rows.append((c, rnd.choice([t, t, None]), rnd.choice(["user", "assistant", "assistant", "system", None, "<says>odd"]), rnd.choice([None, "", "".join(rnd.choice(CONTROL) for _ in range(rnd.randint(0, 12)))])))
    rows += [(99, t, "assistant" if t % 2 else "user", f"turn {t} </turn>") for t in range(700)]
    rows += [(98, 0, "assistant", "same")] * 300
    return rows


def test_op12_round_trip(spark):
    rows = made_chats()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, block string, conversation int").repartition(3)
    out = chat.format_chats(df.withColumn("content", chat.text_parts(F.col("text"))), block=8)
    got = out.select("conv_id", "formatted", "turns", chat.turns_of(F.col("formatted")).alias("read"), chat.taken(F.col("formatted"), F.col("mask")).alias("loss")).collect()
    want = {}
    for c, t, role, text in rows:
        want.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    assert {r.conv_id for r in got} == set(want) and len(got) == len(want)
    for r in got:
        have = [(x.role, x.content) for x in r.read]
        assert r.turns == len(have) and sorted(have) == sorted(x[2:] for x in want[r.conv_id])
        # Rows of one turn may stand in any fixed order.
        if len({w[:2] for w in want[r.conv_id]}) == len(want[r.conv_id]):
            assert have == [w[2:] for w in sorted(want[r.conv_id])]
        assert "".join(r.loss) == "".join(c for role, c in have if role == "assistant")
        assert len(r.loss) == sum(role == "assistant" and bool(c) for role, c in have)


def test_op12_typed_parts(spark):
    part = "struct<kind:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>"
    one = lambda kind, text=None, uri=None, w=None, h=None, s=None, p=None: (kind, text, uri, w, h, s, p)
    rows = [
        (1, 0, "user", [one("text", "look <image/> "), one("image", uri="a.png", w=900, h=448), one("image", uri="b.png"), None]),
        (1, 1, "assistant", [one("text", "I see"), one("audio", uri="c.wav", s=2.5), one("text", " and hear")]),
        (1, 2, "user", [one("document", uri="d.pdf", p=3), one("hologram", uri="e")]),
        (2, 0, "user", None), (3, 0, "assistant", []),
    ]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, content array<{part}>")
    out = chat.format_chats(df).withColumn("loss", chat.taken(F.col("formatted"), F.col("mask"))).withColumn("long", chat.expand(F.col("formatted"), F.col("attachments")))
    got = {r.conv_id: r for r in out.collect()}
    r = got[1]
    assert r.formatted == "<turn>user<says>look <\\image/> <image/><image/></turn><turn>assistant<says>I see<audio/> and hear</turn><turn>user<says><document/><other/></turn>"
    assert [(a.kind, a.uri, a.tokens) for a in r.attachments] == [("image", "a.png", 4 * 256), ("image", "b.png", 256), ("audio", "c.wav", 63), ("document", "d.pdf", 3 * 512), ("other", "e", 0)]
    assert r.loss == ["I see", " and hear"] and r.long.count(chat.PAD) == sum(a.tokens for a in r.attachments) and "<\\image/>" in r.long
    assert got[2].formatted == "<turn>user<says></turn>" and got[3].loss == [] and got[3].attachments == []
    assert sum(m.skip + m.take for m in r.mask) == len(r.formatted)


def test_op12_no_rows_and_plan(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    out = chat.format_chats(none.withColumn("content", chat.text_parts(F.col("text"))))
    assert out.count() == 0
    assert "Python" not in out._jdf.queryExecution().toString()


def runs_by_definition(words):
    """Every maximal run, straight from the definition."""
    out = []
    for q in range(1, len(words) // 4 + 1):
        same = [words[x] == words[x + q] for x in range(len(words) - q)]
        x = 0
        while x < len(same):
            y = x
            while y < len(same) and same[y]:
                y += 1
            seg = words[x : y + q]
            if y > x and len(seg) >= max(6, 4 * q) and not any(all(a == b for a, b in zip(seg, seg[p:], strict=False)) for p in range(1, q)):
                out.append((x, len(seg), q))
            x = y + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic_texts():
    rnd = random.Random(8)
    texts = [None, "", " \n ", "a a a a a", "a a a a a a", "a b a b a b a b", "a b a b a b a", "x " * 5000, ("one two three four five " * 7 + "stop ") * 6, "日 本 " * 9]
    for _ in range(60):
        k, n = rnd.choice([1, 2, 3, 6, 40]), rnd.randint(1, 120)
        words = [f"w{rnd.randrange(k)}" for _ in range(n)]
        a, p = rnd.randrange(n), rnd.randint(1, 12)
        texts.append("  ".join([words[i] if i < a else words[a + (i - a) % min(p, n - a)] for i in range(n)] + words[: rnd.randint(0, 5)]))
    return texts


def test_op13_by_definition(spark):
    texts = periodic_texts()
    df = spark.createDataFrame([(i, t, 1, "c") for i, t in enumerate(texts)] + [(5, texts[5], 1, "c"), (None, "b b b b b b b", 1, "c")], "doc_id long, text string, runs int, collapsed string").repartition(3)
    got = periodic.collapse_runs(df).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        words = WORD.findall((texts[r.doc_id] if r.doc_id is not None else "b b b b b b b") or "")
        want = runs_by_definition(words) if len(words) < 1000 else [(0, len(words), 1)]
        assert [tuple(x) for x in r.runs] == want and r.n_words == len(words)
        dropped = {i for s, n, q in want for i in range(s + q, s + n)}
        assert r.collapsed == " ".join(w for i, w in enumerate(words) if i not in dropped)
    assert periodic.collapse_runs(df.limit(0)).count() == 0


def test_op13_runs_stay_inside_documents():
    codes = np.array([1, 2] * 3 + [1, 2] * 3 + [1, 2] * 4)
    assert periodic.find_runs(codes, np.array([6, 6, 8])).tolist() == [[12, 8, 2]]
    assert periodic.find_runs(np.zeros(0, np.int64), np.zeros(3, np.int64)).tolist() == []


def test_op13_many_long_texts_take_linear_time():
    base = np.random.default_rng(0).integers(0, 30, 2500)
    assert periodic.find_runs(np.tile(base, 40), np.array([100_000])).tolist() == [[0, 100_000, 2500]]


def test_op13_repeated_tails(spark):
    texts = periodic_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    changed = 0
    for r in queries.repeated_tails(df).collect():
        words, h = WORD.findall(texts[r.doc_id] or ""), zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            changed += 1
        assert WORD.findall(r.text) == words
    assert changed > 2


def test_new_queries_against_sql(spark):
    """The registered queries on the smallest tables; the third against the definition."""
    import duckdb

    sf, found, sql = "/root/testdata/sf0.001", queries.queries(), queries.oracle_sql()
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    for name in ("op11_fill_in_middle", "op12_chat_formatting"):
        df = found[name](spark, sf)
        want = con.execute(f"select {', '.join(df.columns)} from ({sql[name]})").fetchall()
        assert sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str)
    texts = dict(con.execute("select doc_id, text from documents").fetchall())
    n_runs = 0
    for r in found["op13_periodic_runs"](spark, sf).collect():
        words, h = WORD.findall(texts[r.doc_id]), zlib.crc32(str(r.doc_id).encode())
        if len(words) > 1500:
            continue
        if h % 10 == 0 and words:
            a = h // 10 % len(words)
            p = 1 + (len(words) - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(len(words))]
        runs = runs_by_definition(words)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None,) * 3
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in dropped).encode()).hexdigest()
        n_runs += len(runs)
    assert n_runs > 5
