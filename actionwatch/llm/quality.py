"""Quality rules with line labels: a linear-chain conditional random field marks lines as content or boilerplate.

Viterbi decoding labels the lines of each whole text; the share of characters in content lines decides retention,
after fixed base rules. The field is trained here on a bounded sample of labelled documents. Labels stand on documents,
so lines get theirs from three sources: what kind of documents hold the same line, the document's own label, and, for
lines of rejected documents that no other document holds, what lines of that look are elsewhere.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_texts, coded_words, pieces, ranges, segment_sums, starts_of, text_of

#: Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MAX_REPEAT = 50, 50
#: A training sample has at most so many labelled documents, and so many lines of each, in so many stretches over the text.
SAMPLE_DOCS, SAMPLE_LINES, STRETCHES = 2000, 100, 4
#: Rounds in which the lines of rejected documents are labelled anew.
LABEL_ROUNDS = 5
#: Content must make up this share of the characters.
CONTENT_SHARE = 0.5
FEATURES = ["bias", "symbols", "uppercase", "digits", "sentence_end", "exclaims", "bars", "short", "long_words", "repeated", "first", "log_words"]
CONTENT, BOILERPLATE = 0, 1
_UPPER, _DIGIT, _SPACE = (np.isin(np.arange(256), list(s)) for s in (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\n\x0b\x0c\r"))
_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
_START = (np.arange(256) & 0xC0) != 0x80
_LETTER = np.isin(np.arange(256), list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")) | (np.arange(256) >= 0xC2)


def lines_of(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """All ``\\n``-split lines that hold a word, and their number in each text."""
    lists = [[x for x in t.split(b"\n") if x.strip()] for t in texts]
    return [x for xs in lists for x in xs], np.fromiter(map(len, lists), np.int64, len(lists))


def base_counts(texts: list[bytes]) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text."""
    n = len(texts)
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, n)
    codes, _, n_words = coded_words(texts)
    repeat = np.zeros(len(codes), bool)
    at = starts_of(n_words)
    windows = np.maximum(n_words - 2, 0)
    first = np.repeat(at[:-1], windows) + _within(windows)
    if len(first):
        _, two = np.unique(codes[first] * (int(codes.max()) + 1) + codes[first + 1], return_inverse=True)
        _, three = np.unique(two * (int(codes.max()) + 1) + codes[first + 2], return_inverse=True)
        _, inverse, times = np.unique(three * n + np.repeat(np.arange(n), windows), return_inverse=True, return_counts=True)
        again = first[times[inverse] > 1]
        for k in range(3):
            repeat[again + k] = True
    dup = np.zeros(n, np.int64)
    for i, t in enumerate(texts):
        lines = [x for x in t.split(b"\n") if x.strip()]
        dup[i] = len(lines) - len(set(lines))
    return {"n_words": n_words, "word_chars": segment_sums((_START & ~_SPACE)[data].astype(np.int64), sizes), "n_symbols": segment_sums(_SYMBOL[data].astype(np.int64), sizes), "n_dup_lines": dup, "n_repeat_words": segment_sums(repeat.astype(np.int64), n_words)}


def _within(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... inside each run."""
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)


def line_features(lines: list[bytes], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A row of features for each line, and its length in characters."""
    n = len(lines)
    if not n:
        return np.zeros((0, len(FEATURES))), np.zeros(0)
    data = np.frombuffer(b"".join(lines), np.uint8)
    sizes = np.fromiter(map(len, lines), np.int64, n)

    def total(table: np.ndarray) -> np.ndarray:
        return segment_sums(table[data].astype(np.int64), sizes).astype(float)

    chars = np.maximum(total(_START & ~_SPACE), 1)
    letters = np.maximum(total(_LETTER), 1)
    words = np.maximum(np.fromiter((len(x.split()) for x in lines), np.int64, n), 1)
    repeated, first = np.zeros(n), np.zeros(n)
    at = starts_of(counts)
    for a, b in zip(at[:-1], at[1:], strict=True):
        if b > a:
            first[a] = 1
            if b - a > 1:
                seen = set()
                for i in range(a, b):
                    repeated[i] = lines[i] in seen
                    seen.add(lines[i])
    one = lambda c: np.fromiter((x.count(c) for x in lines), np.int64, n)
    ends = np.fromiter((x.rstrip().endswith((b".", b"!", b"?", b'"', b":")) for x in lines), bool, n)
    out = np.column_stack([np.ones(n), np.minimum(total(_SYMBOL) / words, 2), total(_UPPER) / letters, total(_DIGIT) / chars, ends, np.minimum(one(b"!!") / words, 1), np.minimum(one(b"|") / words, 1), words < 5, chars / words > 12, repeated, first, np.log(words) / 5])
    return out, chars


class LineField:
    """Weights of a linear-chain field with two labels: emissions (features x 2), transitions (2 x 2)."""

    def __init__(self, emit: np.ndarray, move: np.ndarray):
        self.emit, self.move = emit, move

    def viterbi(self, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The best label sequence of each text, all texts stepping together from the longest down."""
        scores, labels = features @ self.emit, np.zeros(len(features), np.int8)
        at = starts_of(counts)
        order = np.argsort(-counts, kind="stable")
        counts_down = counts[order]
        steps = int(counts.max()) if len(counts) else 0
        if not steps:
            return labels
        live = np.searchsorted(-counts_down, -np.arange(steps), side="left")  # texts with more than k lines
        begin = at[order]
        best = scores[begin[: live[0]]]
        back = []
        for k in range(1, steps):
            m = live[k]
            through = best[:m, :, None] + self.move
            back.append(through.argmax(1).astype(np.int8))
            # Texts that ended keep their last scores.
            best = np.concatenate([through.max(1) + scores[begin[:m] + k], best[m:]])
        label = best.argmax(1).astype(np.int8)
        labels[begin[: live[0]] + counts_down[: live[0]] - 1] = label
        for k in range(steps - 1, 0, -1):
            m = live[k]
            label[:m] = back[k - 1][np.arange(m), label[:m]]
            labels[begin[:m] + k - 1] = label[:m]
        return labels

    @staticmethod
    def train(features: np.ndarray, counts: np.ndarray, labels: np.ndarray, *, rounds: int = 200, rate: float = 0.1, penalty: float = 1e-3, near: float = 1e-3) -> LineField:
        """Maximum likelihood by Adam with scaled forward-backward, until no slope exceeds ``near``. No lines: all content.

        Lines are put in order of their place, texts from the longest down, so each step works on neighbours in memory.
        """
        emit, move = np.zeros((len(FEATURES) if not features.size else features.shape[1], 2)), np.zeros((2, 2))
        if not len(features):
            emit[0, CONTENT] = 1.0
            return LineField(emit, move)
        begin = starts_of(counts)[:-1]
        order = np.argsort(-counts, kind="stable")
        live = np.searchsorted(-counts[order], -np.arange(int(counts.max())), side="left")
        places = np.concatenate([begin[order[:m]] + k for k, m in enumerate(live)])
        x, gold = features[places], np.eye(2)[labels[places]]
        at = starts_of(live)
        later = np.arange(live[0], len(x))
        former = ranges(at[:-2], live[1:])
        gold_emit, gold_move = x.T @ gold, gold[former].T @ gold[later]
        params = np.zeros(emit.size + 4)
        m1, m2 = np.zeros_like(params), np.zeros_like(params)
        for r in range(1, rounds + 1):
            emit, move = params[: emit.size].reshape(emit.shape), np.exp(params[emit.size :].reshape(2, 2))
            score = x @ emit
            local = np.exp(score - score.max(1, keepdims=True))
            ahead, scale = np.empty_like(local), np.empty((len(x), 1))
            for k, m in enumerate(live):
                a, b = at[k], at[k] + m
                now = local[a:b] if not k else (ahead[at[k - 1] : at[k - 1] + m] @ move) * local[a:b]
                scale[a:b] = now.sum(1, keepdims=True)
                ahead[a:b] = now / scale[a:b]
            local /= scale
            behind = np.ones_like(local)
            for k in range(len(live) - 2, -1, -1):
                a, b = at[k + 1], at[k + 2]
                behind[at[k] : at[k] + live[k + 1]] = (local[a:b] * behind[a:b]) @ move.T
            both = (ahead[former].T @ (local * behind)[later]) * move
            grad = np.concatenate([(gold_emit - x.T @ (ahead * behind)).ravel(), (gold_move - both).ravel()]) / len(counts) - penalty * params
            if np.abs(grad).max() < near:
                break
            m1, m2 = 0.9 * m1 + 0.1 * grad, 0.99 * m2 + 0.01 * grad**2
            params = params + rate * (m1 / (1 - 0.9**r)) / (np.sqrt(m2 / (1 - 0.99**r)) + 1e-8)
        return LineField(params[: emit.size].reshape(emit.shape), params[emit.size :].reshape(2, 2))


def line_labels(features: np.ndarray, hashes: np.ndarray, doc: np.ndarray, quality: np.ndarray) -> np.ndarray:
    """A label for each line of a sample; ``doc`` is the line's document, ``quality`` 1 or 0 for each document.

    A line held by several documents is boilerplate where most of them are rejected ones. Other lines of accepted
    documents are content. Other lines of rejected documents begin as boilerplate; then a model of single lines is
    fitted, and they take the label that it gives them, until nothing changes. The line of a rejected document that
    looks most like boilerplate stays boilerplate, as something made it be rejected.
    """
    bad = quality[doc] == 0
    _, line = np.unique(hashes, return_inverse=True)
    pairs = np.unique(line * len(quality) + doc)
    holders = np.bincount(pairs // len(quality))
    rejected = np.bincount(pairs // len(quality), weights=quality[pairs % len(quality)] == 0)
    several = holders[line] > 1
    labels = np.where(several, 2 * rejected[line] > holders[line], bad).astype(np.int64)
    open_ = bad & ~several
    for _ in range(LABEL_ROUNDS):
        model = LineField.train(features, np.ones(len(features), np.int64), labels)
        lead = (features @ model.emit) @ np.array([-1.0, 1.0])
        new = np.where(open_, lead > 0, labels)
        order = np.lexsort((-lead, doc))
        first = order[np.flatnonzero(np.diff(doc[order], prepend=-1))]
        new[first[open_[first]]] = BOILERPLATE
        if (new == labels).all():
            break
        labels = new
    return labels


def stretches(n: int, most: int = SAMPLE_LINES, parts: int = STRETCHES) -> list[tuple[int, int]]:
    """Stretches (from, to) of ``n`` lines: all of them, or ``parts`` equal ones spread from the first line to the last."""
    if n <= most:
        return [(0, n)] if n else []
    size = most // parts
    return [(k * (n - size) // (parts - 1), k * (n - size) // (parts - 1) + size) for k in range(parts)]


def _sample_rows(batches):
    for batch in pieces(batches, "text"):
        lines, counts = lines_of(byte_texts(batch, "text"))
        features, _ = line_features(lines, counts)
        cut = [[(a + i, a + j) for i, j in stretches(n)] for a, n in zip(starts_of(counts)[:-1].tolist(), counts.tolist(), strict=True)]
        sizes = [[j - i for i, j in c] for c in cut]
        hashes = [[xxhash.xxh3_64_intdigest(x) >> 1 for i, j in c for x in lines[i:j]] for c in cut]
        rows = [np.concatenate([np.zeros(0), *(features[i:j].ravel() for i, j in c)]).tolist() for c in cut]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.list_(pa.float64())), pa.array(hashes, pa.list_(pa.int64())), pa.array(sizes, pa.list_(pa.int64()))], ["doc_id", "quality", "features", "hashes", "sizes"])


def labelled_lines(docs: DataFrame, labels: DataFrame, *, sample_docs: int = SAMPLE_DOCS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, lines of each stretch and line labels of the training sample (see ``train_field``)."""
    chosen = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
    rows = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id")
    rows = rows.groupBy("doc_id").agg(F.first("quality").alias("quality"), F.min("text").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(_sample_rows, f"doc_id {kind}, quality int, features array<double>, hashes array<long>, sizes array<long>").collect()
    # At most ``sample_docs`` rows, in an order that no partitioning changes.
    found = sorted((r for r in found if r.hashes), key=lambda r: r.doc_id)
    counts = np.array([n for r in found for n in r.sizes], np.int64)
    features = np.concatenate([np.zeros(0), *(np.asarray(r.features, float) for r in found)]).reshape(-1, len(FEATURES))
    hashes = np.array([h for r in found for h in r.hashes], np.int64)
    quality = np.array([r.quality != 0 for r in found], np.int64)
    if not len(found):
        return features, counts, hashes
    return features, counts, line_labels(features, hashes, np.repeat(np.arange(len(found)), [len(r.hashes) for r in found]), quality)


def train_field(docs: DataFrame, labels: DataFrame, *, sample_docs: int = SAMPLE_DOCS) -> LineField:
    """Fit the field on at most ``sample_docs`` labelled documents (the smallest id hashes).

    Documents without a label, with a null label or a null text are not used; of labels of one id the best counts, of
    documents of one id the least text. A text of more than ``SAMPLE_LINES`` lines gives stretches spread over the whole of
    it, each a sequence of its own. Only feature rows of the sample reach the driver. The field is the same on any
    partitioning of the tables.
    """
    return LineField.train(*labelled_lines(docs, labels, sample_docs=sample_docs))


def judge(texts: list[bytes], field: LineField, content_share: float = CONTENT_SHARE) -> dict[str, np.ndarray]:
    """Base counts and the verdict for each text."""
    out = base_counts(texts)
    lines, counts = lines_of(texts)
    features, chars = line_features(lines, counts)
    content = field.viterbi(features, counts) == CONTENT
    share = segment_sums(chars * content, counts) / np.maximum(segment_sums(chars, counts), 1)
    out["base_failed"] = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > MAX_REPEAT * out["n_words"])
    out["content_share"] = share
    out["n_content_lines"] = segment_sums(content.astype(np.int64), counts)
    out["n_lines"] = counts
    out["kept"] = ~out["base_failed"] & (share >= content_share)
    return out


SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, content_share double, n_lines long, n_content_lines long"
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]


def quality_report(docs: DataFrame, field: LineField, *, id_col: str = "doc_id", content_share: float = CONTENT_SHARE) -> DataFrame:
    """One row for each document: id, counts, base_failed, kept, content_share, n_lines, n_content_lines.

    A null text counts as empty: no words, base_failed, not kept. Repeated rows each get a row; other columns are
    not read. Only the labels see the neighbouring lines, so the work is one pass without a shuffle.
    """

    def run(batches):
        for batch in pieces(batches, "text"):
            found = judge(byte_texts(batch, "text"), field, content_share)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(found[c]) for c in COLUMNS)], [id_col, *COLUMNS])

    rows = docs.select(id_col, text_of().alias("text"))
    return rows.mapInArrow(run, f"`{id_col}` {rows.schema[id_col].dataType.simpleString()}, {SCHEMA}")


def keep_good(docs: DataFrame, field: LineField, *, content_share: float = CONTENT_SHARE) -> DataFrame:
    """The rows of ``docs`` whose text is kept, with all their columns."""

    def run(batches):
        for batch in pieces(batches, "text"):
            kept = judge(byte_texts(batch, "text"), field, content_share)["kept"]
            yield batch.filter(pa.array(kept))

    return docs.mapInArrow(run, docs.schema)
