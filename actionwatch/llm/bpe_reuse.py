"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash cuts texts into chunks at places that depend on the bytes nearby, so a passage gives the same chunks
wherever it stands. Chunk fingerprints are counted over the whole corpus. Texts without a shared chunk are encoded
where they are read. In the others, each shared chunk is encoded once, for all texts, and handed to those that hold
it; their own chunks are encoded beside it. A chunk may end inside a word, so the ids next to a join of two chunks can
be wrong. Each join is repaired: a window around it is encoded again, and its first and last words must have the same
ids there, in the chunk on that side, and alone; where they do not agree, the window grows and is encoded again, up to
the whole text. What then stands left and right of the windows is taken from the chunks.

A Bloom filter of shared fingerprints, sized by their number up to ``FILTER_WORDS``, decides which way a text goes. It
can take a chunk for shared that is not; that chunk then only goes the longer way. Beyond that size the filter fills up
and more texts go that way, with equal results.
"""

from __future__ import annotations

import bisect
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .chunks import CUT, last_cut
from .common import byte_texts, materialize, pieces, ranges, starts_of, text_of
from .encoder import tokenizer, word_encoder

#: A chunk has about 2 ** MASK_BITS bytes; the rolling hash covers 16 bytes.
MASK_BITS = 11
#: The filter has 16 bits for each shared fingerprint, but between so many 64-bit words: 8 KiB to 16 MiB.
LEAST_WORDS, FILTER_WORDS = 1 << 10, 1 << 21
_RANDOM = np.random.RandomState(7).randint(1, 1 << 31, 256, dtype=np.int64).astype(np.uint32)
_M = np.array([0x9E3779B1], np.uint32)


def cut_points(texts: list[bytes]) -> list[list[int]]:
    """Inner chunk borders of each text, found by a rolling hash over the 16 bytes before the border."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    at = starts_of(sizes)
    if len(data) < 17:
        return [[] for _ in texts]
    h, m = _RANDOM[data], _M
    for width in (1, 2, 4, 8):
        h = h[:-width] * m + h[width:]
        m = m * m
    # h[i] covers data[i : i + 16]; a border stands at i + 16, before a character's first byte.
    borders = np.flatnonzero((h[:-1] >> np.uint32(32 - MASK_BITS)) == 0) + 16
    borders = borders[(data[borders] & 0xC0) != 0x80]
    owner = np.searchsorted(at, borders, side="right") - 1
    inside = borders - at[owner]
    good = inside >= 16  # the window lies in the text
    owner, inside = owner[good], inside[good]
    ends = np.searchsorted(owner, np.arange(len(texts) + 1))
    return [inside[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)]


def chunks_of(texts: list[bytes]) -> list[list[bytes]]:
    out = []
    for text, cuts in zip(texts, cut_points(texts), strict=True):
        edges = [0, *cuts, len(text)]
        out.append([text[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)])
    return out


def fingerprint(chunk: bytes) -> bytes:
    return xxhash.xxh3_128_digest(chunk)


def _short(prints: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(prints), "<i8")[::2] if prints else np.empty(0, np.int64)


def _slots(short: np.ndarray, words: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Two (word, bit) places of each fingerprint."""
    u = short.astype(np.uint64)
    return [((u >> np.uint64(s)) & np.uint64(words - 1), np.uint64(1) << ((u >> np.uint64(s + 22)) & np.uint64(63))) for s in (0, 32)]


def shared_filter(rows: DataFrame) -> np.ndarray:
    """The Bloom filter of fingerprints that occur at least twice in all texts."""

    def count(batches):
        for batch in pieces(batches, "text"):
            prints = _short([fingerprint(c) for cs in chunks_of(byte_texts(batch, "text")) for c in cs])
            values, times = np.unique(prints, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(times)], ["print", "n"])

    counted = rows.select("text").mapInArrow(count, "print long, n long").groupBy("print").agg(F.sum("n").alias("n")).where("n > 1")
    shared = materialize(counted.select("print"), "shared-prints")
    words = min(max(LEAST_WORDS, 1 << (shared.count() // 4).bit_length()), FILTER_WORDS)

    def places(batches):
        for batch in batches:
            both = _slots(batch.column(0).to_numpy(), words)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([w for w, _ in both]).astype(np.int64)), pa.array(np.concatenate([b for _, b in both]).view(np.int64))], ["word", "bits"])

    found = shared.mapInArrow(places, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(words, np.uint64)
    out[found.column(0).to_numpy()] = found.column(1).to_numpy().view(np.uint64)
    return out


def _hits(prints: list[bytes], bloom: np.ndarray) -> np.ndarray:
    hit = np.ones(len(prints), bool)
    for word, bit in _slots(_short(prints), len(bloom)):
        hit &= (bloom[word] & bit) != 0
    return hit


def _marked(texts: list[bytes], bloom: np.ndarray):
    """Chunks of each text, their fingerprints and whether the filter takes them for shared."""
    chunks = chunks_of(texts)
    prints = [fingerprint(c) for cs in chunks for c in cs]
    hit = _hits(prints, bloom)
    at = starts_of(np.fromiter(map(len, chunks), np.int64, len(chunks)))
    return chunks, prints, hit, at


def _id_lists(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(starts_of(counts), pa.int32()), pa.array(ids.astype(np.int32)))


def cut_before(text: bytes, at: int) -> int:
    """The last sure token end at or before a place; 0 without one."""
    reach = 256
    while True:
        low = max(0, at + 1 - reach)
        if (found := last_cut(text[low : at + 1])) > 0:
            return low + found
        if not low:
            return 0
        reach *= 8


def cut_after(text: bytes, at: int) -> int:
    """The first sure token end after a place; the text's end without one."""
    m = CUT.search(text, at)
    return m.end() if m else len(text)


def windows_of(text: bytes, borders: list[int], words: int) -> list[tuple[int, int, int, int]]:
    """(begin, end of the first word, begin of the last word, end) of the windows around the inner chunk borders.

    A window has ``words`` sure token ends on either side of its border, and one word more. Windows that meet are one.
    """
    out: list[tuple[int, int, int, int]] = []
    for border in borders:
        left = border
        for _ in range(words):
            left = cut_before(text, left - 1) if left > 0 else 0
        right = border
        for _ in range(words):
            right = cut_after(text, right)
        begin = cut_before(text, left - 1) if left > 0 else 0
        new = (begin, left, right, cut_after(text, right))
        if out and begin <= out[-1][3]:
            new = (*out.pop()[:2], *new[2:])
        out.append(new)
    return out


def join_chunks(texts: list[bytes], chunks: list[list[bytes]], known: dict[tuple[int, int], np.ndarray], encode) -> list[np.ndarray]:
    """Ids of whole texts from the ids of their chunks; ``known`` has some of them, by (text, chunk).

    ``encode`` gives all ids of a list of texts and the number of ids of each.
    """

    def encoded(parts: list[bytes]) -> list[np.ndarray]:
        ids, counts = encode(parts)
        at = starts_of(counts)
        return [ids[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]

    own = [(i, k) for i, cs in enumerate(chunks) for k in range(len(cs)) if (i, k) not in known]
    ids = known | dict(zip(own, encoded([chunks[i][k] for i, k in own]), strict=True))
    out: list[np.ndarray] = [np.empty(0, np.uint32)] * len(texts)
    todo, words = list(range(len(texts))), 1
    while todo:
        parts: list[bytes] = []
        plans = []
        for i in todo:
            edges = starts_of(np.fromiter(map(len, chunks[i]), np.int64, len(chunks[i]))).tolist()
            found = windows_of(texts[i], edges[1:-1], words)
            # What the windows leave of each chunk: between the end of one window and the begin of the next.
            gaps = zip([0, *(w[3] for w in found)], [*(w[0] for w in found), len(texts[i])], strict=True)
            plan = []
            for n, (a, b) in enumerate(gaps):
                k = max(bisect.bisect_right(edges, a) - 1, 0)
                if a < b:
                    plan.append((k, len(parts), n))
                    parts += [texts[i][edges[k] : a], texts[i][b : edges[k + 1]]]
                if n < len(found):
                    begin, left, right, end = found[n]
                    plan.append((None, len(parts), n))
                    parts += [texts[i][begin:end], texts[i][begin:left], texts[i][right:end]]
            plans.append((i, found, plan))
        made = encoded(parts)
        again = []
        for i, found, plan in plans:
            agreed, pieces_ = True, []
            for k, at, n in plan:
                if k is None:
                    whole, first, last = made[at : at + 3]
                    agreed &= _starts(whole, first) and _ends(whole, last)
                    pieces_.append(whole)
                    continue
                have, before, after = ids[i, k], made[at], made[at + 1]
                agreed &= len(before) + len(after) <= len(have) and _starts(have, before) and _ends(have, after)
                # The words at the windows' inner edges, once more: in the chunk as in the window.
                if n:
                    agreed &= _ends(before, encoded_word(made, plan, n - 1, 2))
                if n < len(found):
                    agreed &= _starts(after, encoded_word(made, plan, n, 1))
                pieces_.append(have[len(before) : len(have) - len(after)])
            if agreed:
                out[i] = np.concatenate(pieces_) if pieces_ else out[i]
            else:
                again.append(i)
        todo, words = again, 2 * words
    return out


def encoded_word(made: list[np.ndarray], plan: list[tuple], window: int, which: int) -> np.ndarray:
    """Ids of a window's first (1) or last (2) word alone."""
    return next(made[at + which] for k, at, n in plan if k is None and n == window)


def _starts(ids: np.ndarray, part: np.ndarray) -> bool:
    return len(part) <= len(ids) and bool((ids[: len(part)] == part).all())


def _ends(ids: np.ndarray, part: np.ndarray) -> bool:
    return len(part) <= len(ids) and bool((ids[len(ids) - len(part) :] == part).all())


def encode_documents(docs: DataFrame, *, tokenizer_path: str, decode: bool = False) -> DataFrame:
    """(doc_id, ids array<int>) of each document's whole text, as the library gives them without special tokens.

    With ``decode`` also ``decoded``, the library's decoding of the ids. A null text is empty and has no ids. Equal
    texts with shared chunks are encoded once; repeated rows and equal ids all come out. Columns other than doc_id and text are not read. The tokenizer must drop white space (``encoder``).
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", text_of().alias("text"))
    bloom = spark.sparkContext.broadcast(shared_filter(rows))

    def alone(batches):
        """Encode the texts that have no shared chunk."""
        encoder = word_encoder(tokenizer_path)
        for batch in pieces(batches, "text"):
            texts = byte_texts(batch, "text")
            _, _, hit, at = _marked(texts, bloom.value)
            mask = np.add.reduceat(np.append(hit, False), at[:-1]) == 0
            ids, counts = encoder.encode([t for t, own in zip(texts, mask, strict=True) if own])
            out = [batch.column(0).filter(pa.array(mask)), lists := _id_lists(ids, counts)]
            names = ["doc_id", "ids"]
            if decode:
                out.append(decoder(tokenizer_path).decode(lists))
                names.append("decoded")
            yield pa.RecordBatch.from_arrays(out, names)

    def sharing(batches):
        """Pass on the texts that have one."""
        for batch in pieces(batches, "text"):
            _, _, hit, at = _marked(byte_texts(batch, "text"), bloom.value)
            mask = np.add.reduceat(np.append(hit, False), at[:-1]) > 0
            yield batch.filter(pa.array(mask))

    def held(batches):
        """(key, number, print) of all shared chunks of a text."""
        for batch in pieces(batches, "text"):
            _, prints, hit, at = _marked(byte_texts(batch, "text"), bloom.value)
            number = np.arange(len(prints)) - np.repeat(at[:-1], np.diff(at))
            keys = np.repeat(np.arange(batch.num_rows), np.diff(at))[hit]
            which = np.flatnonzero(hit)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keys)), pa.array(number[which]), pa.array([prints[i] for i in which], pa.binary())], ["key", "number", "print"])

    def bodies(batches):
        """(print, chunk) of all shared chunks, each once a batch."""
        for batch in pieces(batches, "text"):
            chunks, prints, hit, _ = _marked(byte_texts(batch, "text"), bloom.value)
            flat = [c for cs in chunks for c in cs]
            own = {prints[i]: flat[i] for i in np.flatnonzero(hit)}
            yield pa.RecordBatch.from_arrays([pa.array(list(own), pa.binary()), pa.array(list(own.values()), pa.binary())], ["print", "body"])

    def encode_bodies(batches):
        encoder = word_encoder(tokenizer_path)
        for batch in pieces(batches, "body"):
            ids, counts = encoder.encode(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), _id_lists(ids, counts)], ["print", "ids"])

    def assemble(batches):
        """Put texts together from shared and own chunks."""
        encoder = word_encoder(tokenizer_path)
        for batch in pieces(batches, "text"):
            texts = byte_texts(batch, "text")
            lists = batch.column(2)
            flat = lists.flatten()
            numbers, ids = flat.field("number").to_numpy(), flat.field("ids")
            values, id_at = ids.values.to_numpy(zero_copy_only=False).astype(np.uint32), ids.offsets.to_numpy()
            owner = np.repeat(np.arange(len(texts)), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
            known = {(int(i), int(k)): values[a:b] for i, k, a, b in zip(owner, numbers, id_at[:-1], id_at[1:], strict=True)}
            whole = join_chunks(texts, chunks_of(texts), known, encoder.encode)
            counts = np.fromiter(map(len, whole), np.int64, len(whole))
            yield pa.RecordBatch.from_arrays([batch.column(0), _id_lists(np.concatenate(whole) if whole else np.empty(0, np.uint32), counts)], ["key", "ids"])

    columns = ", decoded string" if decode else ""
    done = rows.mapInArrow(alone, f"doc_id {kind}, ids array<int>{columns}")
    keyed = rows.select(F.unhex(F.md5("text")).alias("key"), "text")
    # Equal texts once; what follows reads this table only.
    once = keyed.mapInArrow(sharing, "key binary, text string").groupBy("key").agg(F.first("text").alias("text"))
    once = materialize(once, "sharing-texts")
    encoded = once.select("text").mapInArrow(bodies, "print binary, body binary").groupBy("print").agg(F.first("body").alias("body")).mapInArrow(encode_bodies, "print binary, ids array<int>")
    refs = once.mapInArrow(held, "key binary, number long, print binary")
    handed = refs.join(encoded, "print").groupBy("key").agg(F.collect_list(F.struct("number", "ids")).alias("known"))
    whole = once.join(handed, "key", "left").select("key", "text", "known").mapInArrow(assemble, "key binary, ids array<int>")
    members = rows.select("doc_id", F.unhex(F.md5("text")).alias("key")).join(whole, "key").select("doc_id", "ids")
    if decode:
        members = decode_ids(members, tokenizer_path=tokenizer_path)
    return done.unionByName(members)


class Decoder:
    """The library's decoding of id lists, special tokens included.

    Without a decoder of its own the library joins the tokens with one space; that is done here for many texts at
    once, by copying the tokens' bytes. With one, the library decodes.
    """

    def __init__(self, path: str):
        self.library = tokenizer(path)
        self.plain = self.library.decoder is None
        if self.plain:
            size = self.library.get_vocab_size(with_added_tokens=True)
            tokens = [(self.library.id_to_token(i) or "").encode() + b" " for i in range(size)]
            self.sizes = np.fromiter(map(len, tokens), np.int64, size)
            self.starts = starts_of(self.sizes)[:-1]
            self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def decode(self, ids: pa.ListArray) -> pa.Array:
        if not self.plain:
            return pa.array(self.library.decode_batch(ids.to_pylist(), skip_special_tokens=False), pa.string())
        at = ids.offsets.to_numpy().astype(np.int64)
        values = ids.values.to_numpy(zero_copy_only=False)[at[0] : at[-1]]
        at = at - at[0]
        sizes = self.sizes[values]
        sizes[at[1:][np.diff(at) > 0] - 1] -= 1  # no space after the last token
        data = np.concatenate([np.empty(0, np.uint8), *(self.bytes[ranges(self.starts[values[i : i + DECODE]], sizes[i : i + DECODE])] for i in range(0, len(values), DECODE))])
        offsets = starts_of(sizes)[at]
        return pa.LargeStringArray.from_buffers(len(ids), pa.py_buffer(offsets), pa.py_buffer(data)).cast(pa.string())


#: Ids decoded at once.
DECODE = 1 << 17


@lru_cache(maxsize=2)
def decoder(path: str) -> Decoder:
    return Decoder(path)


def decode_ids(encoded: DataFrame, *, tokenizer_path: str) -> DataFrame:
    """Add ``decoded``: the library's decoding of ``ids``, special tokens included."""
    where = encoded.columns.index("ids")

    def run(batches):
        own = decoder(tokenizer_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                yield pa.RecordBatch.from_arrays([*part.columns, own.decode(part.column(where))], [*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, StructType([*encoded.schema.fields, StructField("decoded", StringType())]))
