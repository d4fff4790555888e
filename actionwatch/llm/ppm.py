"""Language-model scores by prediction by partial matching over bytes.

The trie holds, for contexts of up to four bytes, how often each byte followed in the training texts. A byte's
probability is (2 c - 1) / 2 n in the longest context that has seen it, times the escape d / 2 n of each longer
context that has not (n: occurrences, d: different bytes); bytes already seen in a longer context are excluded from the counts of
shorter ones. Below the empty context the bytes left over are equally likely. An end mark closes each text.

The trie is never in one place. Texts are dealt into blocks of bounded size; a block lists its distinct words and
five-byte grams with their training counts. Grams are summed over the corpus and grouped by the last two bytes of
context: a group holds a whole
subtree of contexts. The code length of every gram goes back
to the blocks that hold it, beside the count of every word, and each block then scores its own texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import byte_texts, coded_words, materialize, pieces, ranges, segment_sums, starts_of, text_of

#: Text bytes of a block.
BLOCK_BYTES = 16 << 20
#: Base model: added to every count.
ADD = 0.1
#: Bytes that never occur in UTF-8: before the start, and after the end.
PAD, END = 0xFE, 0xFF
ORDER = 4
WORD, GRAM = 0, 1
KEYS = "block long, kind int, key binary, n long"


def held_out(doc_id: Column, mod: int = 10) -> Column:
    """Whether a document is kept from training: crc32 of the id as text is divisible by ``mod``. Null: as empty."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % mod == 0


def lowered(texts: list[bytes]) -> list[bytes]:
    """ASCII letters in lower case."""
    return [t.lower() for t in texts]


def text_grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The packed five-byte gram that ends at each byte and end mark of the texts, and the grams of each text."""
    head, tail = bytes([PAD]) * ORDER, bytes([END])
    data = np.frombuffer(b"".join([head + t + tail for t in texts]), np.uint8)
    grams = np.zeros(max(len(data) - ORDER, 0), np.int64)
    for k in range(ORDER + 1):
        grams = grams << 8 | data[k : len(data) - ORDER + k]
    counts = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    begin = starts_of(counts + ORDER)[:-1]
    return grams[ranges(begin, counts)], counts


def packed_keys(grams: np.ndarray) -> pa.Array:
    """The grams' bytes."""
    data = grams.astype(">i8").view(np.uint8).reshape(-1, 8)[:, 7 - ORDER :].tobytes()
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(ORDER + 1), len(grams), [None, pa.py_buffer(data)]).cast(pa.binary())


def unpacked(keys: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Grams of their bytes."""
    keys = keys.combine_chunks() if isinstance(keys, pa.ChunkedArray) else keys
    if not len(keys):
        return np.empty(0, np.int64)
    at = np.frombuffer(keys.buffers()[1], np.int32)[keys.offset : keys.offset + len(keys) + 1]
    data = np.frombuffer(keys.buffers()[2], np.uint8)[at[0] : at[-1]].reshape(-1, ORDER + 1)
    out = np.zeros(len(data), np.int64)
    for k in range(ORDER + 1):
        out = out << 8 | data[:, k]
    return out


class Dense:
    """Dense codes of packed grams by a table look-up for each byte."""

    def __init__(self, grams: np.ndarray, alphabet: np.ndarray):
        """``alphabet``: all bytes that occur."""
        self.alphabet, self.steps = alphabet, []
        place = np.zeros(256, np.int32)
        place[alphabet] = np.arange(len(alphabet))
        kind = np.int32 if len(grams) < 1 << 22 else np.int64
        codes = np.zeros(len(grams), kind)
        for shift in range(8 * ORDER, -1, -8):
            codes = codes * kind(len(alphabet)) + place[(grams >> shift) & 255]
            seen = np.zeros((int(codes.max()) + 1) if len(codes) else 1, bool)
            seen[codes] = True
            self.steps.append(np.flatnonzero(seen))
            codes = (np.cumsum(seen, dtype=kind) - kind(1))[codes]
        self.codes = codes

    def values(self) -> np.ndarray:
        """The distinct grams, by code."""
        up, n = np.zeros(1, np.int64), len(self.alphabet)
        for step in self.steps:
            up = up[step // n] << 8 | self.alphabet[step % n]
        return up


def alphabet_of(texts: list[bytes]) -> np.ndarray:
    seen = np.zeros(256, bool)
    seen[[PAD, END]] = True
    for t in texts:
        seen[np.frombuffer(t, np.uint8)] = True
    return np.flatnonzero(seen)


def _block_keys(batches):
    """Distinct words and grams of each block, with their training counts. Rows come sorted by block."""
    block, words, grams = None, {}, None

    def flush():
        if words:
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(words), block)), pa.array(np.full(len(words), WORD, np.int32)), pa.array(list(words), pa.binary()), pa.array(list(words.values()), pa.int64())], ["block", "kind", "key", "n"])
        if grams is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(grams[0]), block)), pa.array(np.full(len(grams[0]), GRAM, np.int32)), packed_keys(grams[0]), pa.array(grams[1])], ["block", "kind", "key", "n"])

    for batch in pieces(batches, "text"):
        blocks = batch.column(0).to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if blocks[a] != block:
                yield from flush()
                block, words, grams = blocks[a], {}, None
            part = batch.slice(a, b - a)
            weight = part.column(1).to_numpy()
            texts = lowered(byte_texts(part, "text"))
            codes, found, counts = coded_words(texts)
            distinct = found.cast(pa.large_binary()).to_pylist()
            n = np.bincount(codes, weights=np.repeat(weight, counts), minlength=len(distinct)).astype(np.int64).tolist()
            if words:
                for w, k in zip(distinct, n, strict=True):
                    words[w] = words.get(w, 0) + k
            else:
                words = dict(zip(distinct, n, strict=True))
            packed, counts = text_grams(texts)
            dense = Dense(packed, alphabet_of(texts))
            n = np.bincount(dense.codes, weights=np.repeat(weight, counts)).astype(np.int64)
            values = dense.values()
            if grams is not None:
                both = np.concatenate([grams[0], values])
                values, where = np.unique(both, return_inverse=True)
                n = np.bincount(where, weights=np.concatenate([grams[1], n])).astype(np.int64)
            grams = (values, n)
    yield from flush()


def code_lengths(grams: np.ndarray, counts: np.ndarray, low: np.ndarray) -> np.ndarray:
    """log10 probability of each packed gram's last byte after its others.

    ``grams`` hold all grams, with their training counts (0: only in held-out texts), of one or more last two
    context bytes; ``low[256, 256]`` counts bytes after one byte of context, for the two shortest contexts.
    """
    g = grams
    out = np.zeros(len(g))
    open_ = np.ones(len(g), bool)  # not yet predicted
    seen = counts > 0
    prior: tuple[np.ndarray, np.ndarray] | None = None  # (context, byte) pairs seen one order higher, by shorter context
    for order in range(ORDER, -1, -1):
        if order >= 2:
            node = (g[seen] & ((1 << 8 * (order + 1)) - 1)).astype(np.int64)
            nodes, where = np.unique(node, return_inverse=True)
            n = np.bincount(where, weights=counts[seen], minlength=len(nodes)).astype(np.int64)
        elif order == 1:
            ctx, byte = np.nonzero(low)
            nodes, n = ctx.astype(np.int64) << 8 | byte, low[ctx, byte]
        else:
            total = low.sum(0)
            nodes = np.flatnonzero(total).astype(np.int64)
            n = total[nodes]
        mask = (1 << 8 * (order + 1)) - 1
        mine = (g & mask).astype(np.int64)
        contexts, first = np.unique(nodes >> 8, return_index=True)
        sums = np.add.reduceat(n, first) if len(first) else n
        kinds = np.diff(np.append(first, len(nodes)))
        at = np.searchsorted(contexts, mine >> 8)
        known = (at < len(contexts)) & (contexts[np.minimum(at, len(contexts) - 1)] == mine >> 8) if len(contexts) else np.zeros(len(g), bool)
        at = np.where(known, at, 0)
        total_n = sums[at] * known if len(sums) else np.zeros(len(g), np.int64)
        total_d = kinds[at] * known if len(kinds) else np.zeros(len(g), np.int64)
        if prior is not None:
            # Exclude the bytes that the longer context has seen; all of them occur here too.
            longer, shorter_node = prior
            k = np.searchsorted(nodes, shorter_node)
            cut_ctx, inverse = np.unique(longer, return_inverse=True)
            cut_n = np.bincount(inverse, weights=n[k], minlength=len(cut_ctx)).astype(np.int64)
            cut_d = np.bincount(inverse, minlength=len(cut_ctx))
            own = (g & ((1 << 8 * (order + 2)) - 1)) >> 8
            j = np.minimum(np.searchsorted(cut_ctx, own), max(len(cut_ctx) - 1, 0))
            has = cut_ctx[j] == own if len(cut_ctx) else np.zeros(len(g), bool)
            if len(cut_ctx):
                total_n = total_n - cut_n[j] * has
                total_d = total_d - cut_d[j] * has
        k = np.minimum(np.searchsorted(nodes, mine), max(len(nodes) - 1, 0))
        hit = open_ & (nodes[k] == mine) if len(nodes) else np.zeros(len(g), bool)
        # A context in which nothing is left predicts nothing and costs nothing.
        any_left = total_n > 0
        below = 2 * np.maximum(total_n, 1)
        if len(nodes):
            out[hit] += np.log10((2 * n[k][hit] - 1) / below[hit])
        miss = open_ & ~hit
        escape = miss & any_left
        out[escape] += np.log10(total_d[escape] / below[escape])
        open_ = miss
        prior = (nodes >> 8, nodes & ((1 << 8 * order) - 1)) if order else (nodes >> 8, nodes)
        if not order:
            out[open_] -= np.log10(256 - len(nodes))
    return out


def gram_scores(grams: DataFrame) -> DataFrame:
    """(key, value): the code length of each gram, from (key, n) summed over the corpus."""
    # Contexts of one byte and none: at most 256 * 256 counts.
    pair = grams.groupBy(F.substring("key", ORDER, 2).alias("pair")).agg(F.sum("n").alias("n")).where("n > 0").toArrow()
    low = np.zeros((256, 256), np.int64)
    for key, n in zip(pair.column(0).to_pylist(), pair.column(1).to_pylist(), strict=True):
        low[key[0], key[1]] = n
    low_ = grams.sparkSession.sparkContext.broadcast(low)

    def run(batches):
        """Rows come sorted by the last two bytes of context; a subtree is scored when it is complete."""
        held = []

        def score(table):
            value = code_lengths(unpacked(table.column(1)), table.column(2).to_numpy(), low_.value)
            return pa.RecordBatch.from_arrays([table.column(1).combine_chunks(), pa.array(value)], ["key", "value"])

        for batch in batches:
            if not batch.num_rows:
                continue
            groups = batch.column(0).to_numpy()
            last = int(np.searchsorted(groups, groups[-1]))  # from here on the group may go on
            if last or (held and held[-1].column(0)[-1].as_py() != groups[0]):
                held.append(batch.slice(0, last))
                yield score(pa.Table.from_batches(held))
                held = []
            held.append(batch.slice(last))
        if held:
            yield score(pa.Table.from_batches(held))

    group = F.conv(F.hex(F.substring("key", ORDER - 1, 2)), 16, 10).cast("int")
    dealt = grams.select(group.alias("group"), "key", "n").repartition("group").sortWithinPartitions("group")
    return dealt.mapInArrow(run, "key binary, value double")


def score_documents(docs: DataFrame, *, block_bytes: int = BLOCK_BYTES, mod: int = 10) -> DataFrame:
    """One row for each document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes.

    ``score`` is the trie's log10 probability of the whole lower-cased text with its end mark; ``base_score`` that of
    its words and one end token by smoothed word counts. Both learn from the documents that are not held out. A null
    text is empty: one end token. Repeated rows all count and all come out. With no training document each byte is
    equally likely, and the base scores by N = V = 0. Columns other than doc_id and text are not read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", text_of().alias("text"))
    held = held_out(F.col("doc_id"), mod)
    prints = rows.groupBy(F.xxhash64("doc_id", "text").alias("print")).agg(F.count(F.lit(1)).alias("n"), F.count_if(~held).alias("texts"), F.sum(F.octet_length("text")).alias("bytes"))
    size = prints.agg(F.sum("bytes").alias("bytes"), F.sum("texts").alias("texts"), F.max("n").alias("most")).first()
    # Repeated rows go on as one with their number, combined before the shuffle.
    copies = F.count(F.lit(1)).alias("copies")
    counted = rows.groupBy("doc_id", "text").agg(copies) if (size["most"] or 0) > 1 else rows.withColumn("copies", F.lit(1).cast("long"))
    blocks = max(1, -(-int(size["bytes"] or 0) // block_bytes))
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).alias("block")
    weight = F.when(held, F.lit(0).cast("long")).otherwise(F.col("copies")).alias("weight")
    blocked = counted.select(block, weight, "text", "doc_id", "copies").repartition("block")

    keys = materialize(blocked.select("block", "weight", "text").sortWithinPartitions("block").mapInArrow(_block_keys, KEYS), "block-keys")
    sums = materialize(keys.groupBy("kind", "key").agg(F.sum("n").alias("n")), "corpus-counts")
    total = sums.where(F.col("kind") == WORD).agg(F.sum("n").alias("n"), F.count_if(F.col("n") > 0).alias("v")).first()
    ends = int(size["texts"] or 0)  # one end token a training text
    big_n, big_v = int(total["n"] or 0) + ends, int(total["v"]) + (ends > 0)
    base = np.log10(big_n + ADD * (big_v + 1))

    words = sums.where(F.col("kind") == WORD).select("kind", "key", F.col("n").cast("double").alias("value"))
    grams = gram_scores(sums.where(F.col("kind") == GRAM).select("key", "n")).select(F.lit(GRAM).alias("kind"), "key", "value")
    given = keys.select("block", "kind", "key").join(words.unionByName(grams), ["kind", "key"]).select("block", "kind", "key", "value")

    def score(texts_of_block: pa.Table, values: pa.Table) -> pa.Table:
        kinds = values.column("kind").to_numpy()
        is_word = kinds == WORD
        known_words = values.column("key").filter(pa.array(is_word)).combine_chunks().cast(pa.large_binary())
        word_values = values.column("value").filter(pa.array(is_word)).to_numpy()
        gram_keys = unpacked(values.column("key").filter(pa.array(~is_word)))
        gram_values = values.column("value").filter(pa.array(~is_word)).to_numpy()
        order = np.argsort(gram_keys)
        gram_keys, gram_values = gram_keys[order], gram_values[order]
        out = []
        for part in pieces(texts_of_block.to_batches(), "text"):
            texts = lowered(byte_texts(part, "text"))
            codes, distinct, n_words = coded_words(texts)
            at = pc.index_in(distinct.cast(pa.large_binary()), value_set=known_words).to_numpy(zero_copy_only=False).astype(np.int64)
            counts = word_values[at] if len(at) else np.empty(0)
            base_sums = segment_sums(np.log10(counts + ADD)[codes], n_words) + np.log10(ends + ADD) - (n_words + 1) * base
            n_known = segment_sums((counts > 0)[codes].astype(np.int64), n_words) + (ends > 0)
            packed, n_grams = text_grams(texts)
            dense = Dense(packed, alphabet_of(texts))
            lengths = gram_values[np.searchsorted(gram_keys, dense.values())]
            sums_ = segment_sums(lengths[dense.codes], n_grams)
            out.append(pa.Table.from_arrays([part.column(part.schema.get_field_index("doc_id")), part.column(part.schema.get_field_index("copies")), pa.array(part.column(1).to_numpy() == 0), pa.array(n_words + 1), pa.array(n_known), pa.array(np.full(len(texts), big_n)), pa.array(base_sums), pa.array(sums_), pa.array(n_grams - 1)], OUT))
        return pa.concat_tables(out)

    left, right = blocked.groupBy("block"), given.groupBy("block")
    found = left.cogroup(right).applyInArrow(score, f"doc_id {kind}, copies long, {SCHEMA}")
    if (size["most"] or 0) > 1:
        found = found.withColumn("copies", F.explode(F.array_repeat("copies", F.col("copies").cast("int"))))
    return found.drop("copies")


SCHEMA = "held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long"
OUT = ["doc_id", "copies", *(c.split()[0] for c in SCHEMA.split(", "))]
