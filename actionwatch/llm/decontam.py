"""Benchmark decontamination: a BM25 index of test items asked by every passage of the training texts.

The index maps terms to items with BM25 impacts, divided by the item's score against itself, so one threshold fits
items of any length: a passage that holds a whole item scores 1. Every text is asked whole, as overlapping passages.
Block-max WAND runs over a batch of passages at once. A passage's terms are put in ascending order of their upper
bounds; the pivot is the first with which the running sum meets the threshold. An item that reaches the threshold
holds a term from the pivot on, so only blocks of items in the lists of those terms are looked at. The block maxima of
these, plus the bounds of the terms before the pivot, must meet the threshold; then the block maxima of all terms; and
only then is a block scored item by item. Found items are verified: enough of the question's and of the answer's word
runs must stand in the passage.

Items are in classes of up to 64, 128, 256 ... words, and each class is asked by passages of its own width. So the
passages that an item meets depend on its own length, and neither on other items nor on how the index is cut.

An index of at most ``SHARD_POSTINGS`` postings and ``SHARD_BYTES`` of item texts is sent to every executor and asked in
one pass. A larger one is cut into shards of about that size; each is sent, asked by all texts and taken back before the
next is built.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_texts, materialize, pieces, ranges, starts_of, text_of

#: BM25 parameters, items a block, and the share of an item's own score that a passage must reach.
K1, B, BLOCK, THRESHOLD = 1.2, 0.75, 8, 0.5
#: Shares of the question's and answer's word runs that must stand in the passage.
QUESTION, ANSWER = 0.6, 0.5
#: An index shard has about so many postings; more items make more shards, each asked by all passages.
SHARD_POSTINGS = 1_000_000
#: And about so many bytes of item texts (an item is never cut).
SHARD_BYTES = 32 << 20
#: Candidates (passage and block, or passage, block and term) handled at once; one passage alone may have more.
SLICE = 1 << 20
#: Largest table of (term, block) places.
TABLE = 1 << 22
#: Word runs of items that a worker keeps.
PARTS = 1_000_000
#: Passages of so many new words for items of up to as many words; twice, four times ... as many for longer ones.
STRIDE = 64
#: ASCII letters in lower case, ASCII punctuation as space.
NORMAL = bytes(ord(chr(b).lower()) if b < 128 and chr(b).isalnum() else b if b >= 128 else 32 for b in range(256))
SENTENCE_END = re.compile(r"[.?!](?=\s|$)")


def terms_of(text: str) -> list[bytes]:
    """Words in lower case without punctuation."""
    return text.encode().translate(NORMAL).split()


def question_and_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """The last sentence, but at least eight words or a quarter of the item, is the answer; the rest the question.

    An item of under 16 words is all question and all answer.
    """
    words = terms_of(text)
    if len(words) < 16:
        return words, words
    ends = [m.end() for m in SENTENCE_END.finditer(text.rstrip())]
    last = len(terms_of(text[ends[-2] :])) if len(ends) > 1 else 0
    n = min(max(last, 8, len(words) // 4), len(words) - 8)
    return words[:-n], words[-n:]


def runs(words: list[bytes], n: int) -> set[tuple[bytes, ...]]:
    """All runs of ``n`` words (all words, where there are fewer)."""
    n = min(n, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


@dataclass
class Shard:
    """Items of one length class, ready to be asked: arrays only."""

    item_ids: list
    texts: list[str]
    vocabulary: list[bytes]
    upper: np.ndarray  # largest impact of each term
    posts: np.ndarray  # term * items + item, ascending
    impacts: np.ndarray
    block_posts: np.ndarray  # term * blocks + block, ascending
    maxima: np.ndarray
    stride: int

    def __post_init__(self):
        self.blocks = len(self.texts) // BLOCK + 1
        size = len(self.vocabulary) * self.blocks
        # A table of places where it is small, else a search.
        self.places = np.full(size, -1, np.int32) if size <= TABLE else None
        if self.places is not None:
            self.places[self.block_posts] = np.arange(len(self.block_posts))

    def block_at(self, term: np.ndarray, block: np.ndarray) -> np.ndarray:
        """Place of each (term, block) in ``block_posts``, or -1."""
        key = term * self.blocks + block
        if self.places is not None:
            return self.places[key]
        at = np.minimum(np.searchsorted(self.block_posts, key), len(self.block_posts) - 1)
        return np.where(self.block_posts[at] == key, at, -1)


def index_of(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries (entry, item_id, text) and postings (entry, term, impact) of the index, both written.

    Each different pair of id and text is an entry of its own. Impacts are over the entry's own score.
    """
    rows = items.select("item_id", text_of().alias("text")).distinct()
    key = F.md5(F.concat_ws("|", F.coalesce(F.col("item_id").cast("string"), F.lit("-")), "text"))
    rows = materialize(rows.select(key.alias("entry"), "item_id", "text"), "index-entries")
    # As ``terms_of``: ASCII only.
    lowered = F.translate(F.col("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.filter(F.split(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")
    sized = rows.select("entry", words.alias("words")).where(F.size("words") > 0)
    shape = sized.agg(F.count(F.lit(1)).alias("n"), F.avg(F.size("words")).alias("mean")).first()
    tf = sized.select("entry", F.size("words").alias("size"), F.explode("words").alias("term")).groupBy("entry", "size", "term").count()
    df = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log1p((F.lit(float(shape["n"])) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    impact = idf * F.col("count") * (K1 + 1) / (F.col("count") + K1 * (1 - B + B * F.col("size") / F.lit(float(shape["mean"] or 1))))
    scored = materialize(tf.join(df, "term").select("entry", "term", impact.alias("impact")), "impacts")
    own = scored.groupBy("entry").agg(F.sum("impact").alias("own"))
    return rows, materialize(scored.join(own, "entry").select("entry", "term", (F.col("impact") / F.col("own")).alias("impact")), "index-postings")


def stride_of(words: int) -> int:
    """New words of the passages for an item: the least of 64, 128, 256 ... that holds it."""
    stride = STRIDE
    while stride < words:
        stride *= 2
    return stride


def build_shards(entries: pa.Table, postings: pa.Table) -> list[Shard]:
    """A shard for each length class of the given entries."""
    strides = pa.array([stride_of(len(terms_of(t))) for t in entries.column("text").to_pylist()], pa.int64())
    out = []
    for stride in pc.unique(strides).to_pylist():
        mine = entries.filter(pc.equal(strides, stride))
        out.append(build_shard(mine, postings.filter(pc.is_in(postings.column("entry"), value_set=mine.column("entry").combine_chunks())), stride))
    return out


def build_shard(entries: pa.Table, postings: pa.Table, stride: int = STRIDE) -> Shard:
    """Arrays of the given entries and their postings."""
    used = pc.is_in(entries.column("entry"), value_set=pc.unique(postings.column("entry")))
    entries = entries.filter(used).sort_by([("item_id", "ascending"), ("entry", "ascending")])
    n, blocks = entries.num_rows, entries.num_rows // BLOCK + 1
    item = pc.index_in(postings.column("entry"), value_set=entries.column("entry").combine_chunks()).to_numpy().astype(np.int64)
    vocabulary = pc.unique(postings.column("term")).sort()
    term = pc.index_in(postings.column("term"), value_set=vocabulary).to_numpy().astype(np.int64)
    order = np.lexsort((item, term))
    term, item, impact = term[order], item[order], postings.column("impact").to_numpy()[order]
    block_posts, first = np.unique(term * blocks + item // BLOCK, return_index=True)
    texts = entries.column("text").to_pylist()
    upper = np.maximum.reduceat(impact, np.searchsorted(term, np.arange(len(vocabulary)))) if len(term) else np.zeros(0)
    return Shard(
        entries.column("item_id").to_pylist(), texts, [v.encode() for v in vocabulary.to_pylist()], upper, term * n + item, impact,
        block_posts, np.maximum.reduceat(impact, first) if len(first) else impact, stride,
    )


def _slices(sizes: np.ndarray):
    """Ranges of neighbours whose sizes add up to about ``SLICE`` at the most."""
    upto, at = np.cumsum(sizes), 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + SLICE, side="right")))
        yield at, to
        at = to


def retrieve(shard: Shard, passage: np.ndarray, term: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All (passage, item, score) with a score of at least ``threshold``; ``passage`` and ``term``: distinct pairs."""
    least, found = threshold - 1e-9, []
    order = np.lexsort((shard.upper[term], passage))
    passage, term = passage[order], term[order]
    upper = shard.upper[term]
    names, begin = np.unique(passage, return_index=True)
    ends = np.append(begin[1:], len(passage))
    who = np.repeat(np.arange(len(names)), ends - begin)
    running = np.cumsum(upper)
    running -= (running - upper)[begin][who]
    # From the pivot on; where no term brings the sum to the threshold, no item can have it.
    beyond = running >= least
    below = np.bincount(who, weights=upper * ~beyond, minlength=len(names))
    before = np.bincount(who[~beyond], minlength=len(names))
    blocks = shard.blocks
    lists = np.searchsorted(shard.block_posts, np.stack([term, term + 1]) * blocks)
    counts = (lists[1] - lists[0]) * beyond
    for s, e in _slices(np.add.reduceat(counts, begin) if len(begin) else counts):
        a, b = begin[s], ends[e - 1]
        at = ranges(lists[0][a:b], counts[a:b])
        if not len(at):
            continue
        key, where = np.unique(np.repeat(who[a:b], counts[a:b]) * blocks + shard.block_posts[at] % blocks, return_inverse=True)
        bound = np.bincount(where, weights=shard.maxima[at], minlength=len(key))
        good = bound + below[key // blocks] >= least
        key, bound = key[good], bound[good]
        for i, j in _slices((ends - begin)[key // blocks]):
            found += _score_blocks(shard, key[i:j], bound[i:j], begin, begin + before, ends, term, least)
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    pair, score = (np.concatenate(x) for x in zip(*found, strict=True))
    n = len(shard.texts)
    return names[pair // n], pair % n, score


def _score_blocks(shard: Shard, key: np.ndarray, bound: np.ndarray, begin: np.ndarray, pivot: np.ndarray, ends: np.ndarray, term: np.ndarray, least: float):
    """Add the block maxima of the terms before the pivot to the bound of each (passage, block), then score what is left."""
    blocks, n = shard.blocks, len(shard.texts)

    def spread(key, to):
        size = (to - begin)[key // blocks]
        return np.repeat(np.arange(len(key)), size), term[ranges(begin[key // blocks], size)]

    row, terms = spread(key, pivot)
    at = shard.block_at(terms, (key % blocks)[row])
    bound = bound + np.bincount(row, weights=np.where(at < 0, 0, shard.maxima[at]), minlength=len(key))
    key = key[bound >= least]
    if not len(key):
        return []
    row, terms = spread(key, ends)
    first = (key % blocks)[row]
    # Postings of each term inside the block.
    held = shard.block_at(terms, first) >= 0
    row, terms, first = row[held], terms[held], first[held] * BLOCK
    low, high = np.searchsorted(shard.posts, np.stack([terms * n + first, terms * n + np.minimum(first + BLOCK, n)]))
    at = ranges(low, high - low)
    pair, where = np.unique(np.repeat((key // blocks)[row], high - low) * n + shard.posts[at] % n, return_inverse=True)
    score = np.bincount(where, weights=shard.impacts[at], minlength=len(pair))
    return [(pair[score >= least], score[score >= least])]


class Asker:
    """Asks one shard with whole texts."""

    def __init__(self, shard: Shard, threshold: float):
        self.shard, self.threshold = shard, threshold
        self.vocabulary = pa.array(shard.vocabulary, pa.large_binary()).cast(pa.large_string())
        self.parts: dict[int, tuple] = {}
        self.kept = 0

    def part(self, item: int) -> tuple:
        """Question runs, answer runs and their lengths of an item."""
        known = self.parts.get(item)
        if known is None:
            q, a = question_and_answer(self.shard.texts[item])
            known = (runs(q, 5), runs(a, 2), min(5, len(q)), min(2, len(a)))
            if self.kept >= PARTS:
                self.parts.clear()
                self.kept = 0
            self.parts[item] = known
            self.kept += len(known[0]) + len(known[1])
        return known

    def ask(self, texts: list[bytes]) -> list[tuple[int, int, float, float, float]]:
        """(text, item, score, question share, answer share) of all verified items, the best passage of each."""
        plain = [t.translate(NORMAL) for t in texts]
        lists = pc.ascii_split_whitespace(pa.array(plain, pa.large_binary()).cast(pa.large_string()))
        counts = np.diff(lists.offsets.to_numpy()).astype(np.int64)
        found = pc.index_in(lists.flatten(), value_set=self.vocabulary)
        codes = found.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        stride = self.shard.stride
        # A window of two strides starts at each stride, so every run of a stride's length lies in one.
        windows = np.maximum(-(-counts // stride) - 1, 1)
        first_window = starts_of(windows)
        text_at = starts_of(counts)
        place = np.arange(len(codes)) - np.repeat(text_at[:-1], counts)
        slot = place // stride
        base, last = np.repeat(first_window[:-1], counts), np.repeat(windows, counts) - 1
        here = codes >= 0
        own, before = base + np.minimum(slot, last), base + np.maximum(slot - 1, 0)
        passage = np.concatenate([own[here], before[here]])
        size = max(len(self.shard.vocabulary), 1)
        key = np.sort(passage * size + np.concatenate([codes[here], codes[here]]))
        key = key[np.append(True, key[1:] != key[:-1])] if len(key) else key
        who, item, score = retrieve(self.shard, key // size, key % size, self.threshold)
        best: dict[tuple[int, int], tuple] = {}
        words: dict[int, list[bytes]] = {}
        for w, i, s in zip(who.tolist(), item.tolist(), score.tolist(), strict=True):
            t = int(np.searchsorted(first_window, w, side="right")) - 1
            if t not in words:
                words = {t: plain[t].split()}
            at = (w - int(first_window[t])) * stride
            # Empty leading words of the split shift places by one at most.
            window = words[t][max(at - 1, 0) : at + 2 * stride + 1]
            q, a, nq, na = self.part(i)
            share_q = len(q & runs_of(window, nq)) / len(q) if q else 0.0
            share_a = len(a & runs_of(window, na)) / len(a) if a else 0.0
            if share_q >= QUESTION and share_a >= ANSWER:
                best[t, i] = max(best.get((t, i), (0.0, 0.0, 0.0)), (s, share_q, share_a))
        return [(t, i, *v) for (t, i), v in sorted(best.items())]


def runs_of(words: list[bytes], n: int) -> set[tuple[bytes, ...]]:
    return set(zip(*(words[k:] for k in range(n)), strict=False)) if n else set()


MATCH = "array<struct<item_id:long,score:double,question:double,answer:double>>"
MATCH_STRUCT = pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("question", pa.float64()), ("answer", pa.float64())])


def _asking(shards, threshold: float):
    """A function that gives the matches of each text; the askers are built once a worker's task."""
    held: list[Asker] = []

    def ask(texts: list[bytes]) -> list[list[dict]]:
        if not held:
            held.extend(Asker(s, threshold) for s in shards.value)
        out: list[list[dict]] = [[] for _ in texts]
        for asker in held:
            for t, i, s, q, a in asker.ask(texts):
                out[t].append({"item_id": asker.shard.item_ids[i], "score": s, "question": q, "answer": a})
        return out

    return ask


def _plan(items: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Entries and postings of the index, and the number of shards."""
    entries, postings = index_of(items)
    size = entries.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    return entries, postings, max(-(-postings.count() // SHARD_POSTINGS), -(-size // SHARD_BYTES))


def _broadcast(entries: DataFrame, postings: DataFrame, k: int, n: int):
    """Shard ``k`` of ``n``, on every executor."""
    mine = F.pmod(F.xxhash64("entry"), F.lit(n)) == k
    return entries.sparkSession.sparkContext.broadcast(build_shards(entries.where(mine).toArrow(), postings.where(mine).toArrow()))


def _hits(rows: DataFrame, entries: DataFrame, postings: DataFrame, n: int, threshold: float) -> DataFrame:
    """(key, matches) of the texts that match an item of any of ``n`` shards; the key is the text's MD5.

    A pass over the texts for each shard; its hits are written before the shard is taken back.
    """
    keyed, out = rows.select(F.unhex(F.md5("text")).alias("key"), "text"), None
    for k in range(n):
        shard = _broadcast(entries, postings, k, n)

        def run(batches, shard=shard):
            ask = _asking(shard, threshold)
            for batch in pieces(batches, "text"):
                found = ask(byte_texts(batch, "text"))
                pairs = [(key, m) for key, ms in zip(batch.column(0).to_pylist(), found, strict=True) for m in ms]
                if pairs:
                    yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in pairs], pa.binary()), pa.array([m for _, m in pairs], MATCH_STRUCT)], ["key", "match"])

        part = materialize(keyed.mapInArrow(run, f"key binary, match {MATCH[6:-1]}"), "hits")
        shard.destroy()
        out = part if out is None else out.unionByName(part)
    return out.groupBy("key").agg(F.array_sort(F.collect_set("match")).alias("matches"))


def find_leaks(docs: DataFrame, benchmark: DataFrame, *, threshold: float = THRESHOLD) -> DataFrame:
    """One row for each document: doc_id, contaminated, matches (verified items, by item_id).

    Null and empty texts match nothing. Each different text of an item id is an item of its own, also where the id is
    null; items without a word match nothing. Repeated documents each get a row. Other columns are not read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", text_of().alias("text"))
    entries, postings, n = _plan(benchmark)
    if n > 1:
        found = rows.select("doc_id", F.unhex(F.md5("text")).alias("key")).join(_hits(rows, entries, postings, n, threshold), "key", "left")
        return found.select("doc_id", F.col("matches").isNotNull().alias("contaminated"), F.coalesce("matches", F.array().cast(MATCH)).alias("matches"))
    shard = _broadcast(entries, postings, 0, 1)

    def run(batches):
        ask = _asking(shard, threshold)
        for batch in pieces(batches, "text"):
            matches = ask(byte_texts(batch, "text"))
            for m in matches:
                m.sort(key=lambda x: (x["item_id"] is not None, x["item_id"], x["score"]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([bool(m) for m in matches], pa.bool_()), pa.array(matches, pa.list_(MATCH_STRUCT))], ["doc_id", "contaminated", "matches"])

    return rows.mapInArrow(run, f"doc_id {kind}, contaminated boolean, matches {MATCH}")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, *, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that hold no verified test item, with all their columns."""
    entries, postings, n = _plan(benchmark)
    if n > 1:
        hits = _hits(docs.select(text_of().alias("text")), entries, postings, n, threshold).select(F.col("key").alias("_leaked"))
        return docs.join(hits, F.unhex(F.md5(text_of())) == F.col("_leaked"), "left_anti").select(docs.columns)
    shard = _broadcast(entries, postings, 0, 1)

    def run(batches):
        ask = _asking(shard, threshold)
        for batch in pieces(batches, "text"):
            yield batch.filter(pa.array([not m for m in ask(byte_texts(batch, "text"))], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
