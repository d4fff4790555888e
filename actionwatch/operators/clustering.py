"""Clustering reports of a group into events (LIF-04).

Texts become sets of word runs; equal texts of a group go on as one. MinHash bands give buckets, and all pairs of a
bucket are compared: buckets are split into blocks, and blocks meet in pairs, so no task holds more than two blocks.
A row of a bucket carries one bit of each hash; comparing these leaves few rows but those of similar texts, which then get
their signatures. Comparing these gives only the texts of a bucket that have a candidate there, a row each. They get their
sets and are dealt out anew, in blocks bounded by bytes; the same comparison gives the pairs again inside the task, which
verifies them exactly and gives for each text the least one it is connected with there. Components of these few links
are joined by label rounds written to the shared folder.

A bucket of more texts than a block goes in two steps. First it is cut into small buckets of its own by a hash, other
ones in every band, which connects a family of similar texts by rows in proportion to its size. Then, of the buckets
that still hold several components, the texts outside the largest one meet each other and those of the largest; pairs
inside it need no link any more. The result is that of comparing all pairs.

A group of few texts needs no bands: it is one bucket, and its texts go once for each of its blocks instead of once a band.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import written


def plain_text(text: Column) -> Column:
    """Lower-case words with one space between them; null is empty."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"\s+", " "))


def text_key(group: Column, words: Column) -> Column:
    """The key of a text in its group."""
    return F.unhex(F.md5(F.concat(F.md5(group.cast("string")), words)))


def keyed_texts(df: DataFrame, *, group: str, row: str, text: str) -> DataFrame:
    """(group, row, key, words): equal words of a group share the key. Rows without a group, an id or a word are left out."""
    # Asked of the text as it is: asked of its words, Spark would make these twice.
    rows = df.where(F.col(group).isNotNull() & F.col(row).isNotNull() & F.col(text).rlike(r"\S")).select(group, row, plain_text(F.col(text)).alias("words"))
    return rows.withColumn("key", text_key(F.col(group), F.col("words")))


def _mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer on unsigned 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signatures(values: np.ndarray, sizes: np.ndarray, hashes: int) -> np.ndarray:
    """A row of ``hashes`` MinHash bytes for each set, of independent orders. Sets are not empty."""
    factors, summands = _mix(np.arange(1, 2 * hashes + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).reshape(2, hashes)
    factors |= np.uint64(1)
    out = np.empty((len(sizes), hashes), np.uint8)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):  # pieces that stay in a core's cache
        base = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + 50_000, side="right")))
        part, first = values[base : int(ends[to - 1])], ends[at:to] - sizes[at:to] - base
        order = np.empty_like(part)
        for k in range(hashes):
            np.multiply(part, factors[k], out=order)
            order += summands[k]
            out[at:to, k] = _mix(np.minimum.reduceat(order, first)) >> np.uint64(56)
        at = to
    return out


def fewest_matches(n: int, threshold: float, lost: float = 1e-9) -> int:
    """The equal bytes of ``n`` that a pair at the threshold has but with a probability of ``lost``."""
    below = 0.0
    for m in range(n + 1):
        below += math.comb(n, m) * threshold**m * (1 - threshold) ** (n - m)
        if below > lost:
            return m
    return n


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenated ``arange(start, start + count)``."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))


def run_hashes(texts: pa.Array, seeds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each run of ``n`` words of the texts, and their number for each text.

    Texts are words with one space between them, at least one. A text of fewer words is one run. The seed of a text's
    group goes in, so runs of different groups differ.
    """
    lists = pc.split_pattern(texts.cast(pa.large_string()), " ")
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    distinct, codes = coded.dictionary, coded.indices.to_numpy()
    lengths = pc.binary_length(distinct).to_numpy().astype(np.int64)
    ends = np.cumsum(lengths)
    data = np.frombuffer(distinct.buffers()[2], np.uint8)[: int(ends[-1])]
    place = np.arange(len(data), dtype=np.uint64) - np.repeat(ends - lengths, lengths).astype(np.uint64)
    # A sum of bytes, each times a factor of its place.
    letters = _mix((place + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)) * (data.astype(np.uint64) + np.uint64(1))
    table = _mix(np.add.reduceat(letters, ends - lengths) + lengths.astype(np.uint64))
    words = table[codes]
    sizes = np.maximum(counts - n + 1, 1)
    begin = _ranges(np.cumsum(counts) - counts, sizes)
    length = np.repeat(np.minimum(counts, n), sizes)
    out = np.repeat(_mix(seeds.view(np.uint64)), sizes) + length.astype(np.uint64)
    for k in range(n):
        use = k < length
        out[use] = _mix(out[use] * np.uint64(0x100000001B3) + words[begin[use] + k])
    return out, sizes


def _pieces(batches, column: int, most: int = 2 << 20):
    """Record batches cut so that the texts of a piece hold about ``most`` bytes."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right")))
            yield batch.slice(at, to - at)
            at = to


def _sketch(words: int, hashes: int):
    def run(batches):
        for batch in _pieces(batches, 4):
            found = signatures(*run_hashes(batch.column(4), batch.column(3).to_numpy(), words), hashes)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([x.tobytes() for x in found], pa.binary())], [*batch.schema.names[:3], "sig"])

    return run


def _sets(words: int):
    """(key, distinct hashes of the text's runs)."""

    def run(batches):
        for batch in _pieces(batches, 2):
            values, sizes = run_hashes(batch.column(2), batch.column(1).to_numpy(), words)
            each = [np.unique(x) for x in np.split(values, np.cumsum(sizes)[:-1])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in each], pa.binary())], ["key", "set"])

    return run


def _sketched_sets(words: int, hashes: int):
    """(key, signature, distinct hashes of the text's runs)."""

    def run(batches):
        for batch in _pieces(batches, 2):
            values, sizes = run_hashes(batch.column(2), batch.column(1).to_numpy(), words)
            found = signatures(values, sizes, hashes)
            each = [np.unique(x) for x in np.split(values, np.cumsum(sizes)[:-1])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([x.tobytes() for x in y], pa.binary()) for y in (found, each))], ["key", "sig", "set"])

    return run


def packed(sig: np.ndarray) -> np.ndarray:
    """The lowest bit of each byte of the signatures, as rows of whole 64-bit words."""
    bits = np.packbits(sig & np.uint8(1), axis=1)
    return np.pad(bits, ((0, 0), (0, -bits.shape[1] % 8)))


def _bits(hashes: int):
    """The bits of signatures in the last column, in their place."""

    def run(batches):
        for batch in batches:
            bits = packed(np.frombuffer(b"".join(batch.column(batch.num_columns - 1).to_pylist()), np.uint8).reshape(-1, hashes))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array([x.tobytes() for x in bits], pa.binary())], [*batch.schema.names[:-1], "bits"])

    return run


def _bands(bands: int, per_band: int):
    """A bucket number for each band: a hash of the band and its bytes."""

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(n, bands, per_band)
            bucket = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (n, bands))
            for k in range(per_band):
                bucket = _mix(bucket * np.uint64(0x100000001B3) + sig[:, :, k])
            bits, each = pa.array([x.tobytes() for x in packed(sig.reshape(n, -1))], pa.binary()), pa.array(np.repeat(np.arange(n), bands))
            yield pa.RecordBatch.from_arrays([pa.array(bucket.ravel().view(np.int64)), pa.array(np.tile(np.arange(bands, dtype=np.int32), n)), batch.column(0).take(each), bits.take(each)], ["bucket", "band", "key", "bits"])

    return run


def _groups(batches):
    """Tables of one (bucket, i, j) each from rows sorted by these first columns."""
    held = []
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = np.stack([batch.column(c).to_numpy() for c in range(3)], 1)
        edges = [0, *(np.flatnonzero((ids[1:] != ids[:-1]).any(1)) + 1).tolist(), len(ids)]
        for s, e in zip(edges, edges[1:], strict=False):
            if held and (s or held[-1][0] != tuple(ids[0])):
                yield pa.Table.from_batches([b for _, b in held]).combine_chunks()
                held = []
            held.append((tuple(ids[s]), batch.slice(s, e - s)))
    if held:
        yield pa.Table.from_batches([b for _, b in held]).combine_chunks()


def _pairs(table: pa.Table, bands: int, per_band: int, looks: list[int], need: list[int]):
    """(row, rows after it) whose signatures agree often enough, in the first band in which they meet (in any, if -1)."""
    i, j, band = (table.column(c)[0].as_py() for c in range(1, 4))
    block = table.column(4).to_numpy()
    sig = np.frombuffer(b"".join(table.column(6).to_pylist()), np.uint8).reshape(-1, bands * per_band)
    left, right = (np.flatnonzero(block == x) for x in (i, j))
    for x in left.tolist():
        b = right[right > x] if i == j else right
        matches, done = np.zeros(len(b), np.int64), 0
        for look, least in zip(looks, need, strict=True):
            matches += (sig[b, done:look] == sig[x, done:look]).sum(1)
            done = look
            good = matches >= least
            b, matches = b[good], matches[good]
        if len(b) and band >= 0:
            equal = (sig[b] == sig[x]).reshape(len(b), bands, per_band).all(2)
            b = b[equal.argmax(1) == band]
        if len(b):
            yield x, b


def _whole_groups(batches):
    """Record batches of whole (bucket, i, j) groups from rows sorted by these first columns."""
    held = []
    for batch in batches:
        if not batch.num_rows:
            continue
        same = np.ones(batch.num_rows, bool)
        for c in range(3):
            values = batch.column(c).to_numpy()
            same &= values == values[-1]
        last = batch.num_rows - (batch.num_rows if same.all() else int(same[::-1].argmin()))
        if last:
            yield pa.Table.from_batches([*held, batch.slice(0, last)]).combine_chunks()
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


#: Pairs of bits compared at once in a task.
PAIRS = 1 << 17


def _near(hashes: int, threshold: float):
    """The rows of each group that agree with another in often enough a bit, one of the two fresh.

    Rows are sorted by block: of a pair of two blocks, the second's rows end the group.
    """

    def run(batches):
        # Bits of different runs agree by chance in one half.
        most = hashes - fewest_matches(hashes, (1 + threshold) / 2)
        for table in _whole_groups(batches):
            bucket, i, j, block = (table.column(c).to_numpy() for c in (0, 1, 2, 4))
            fresh, n = table.column(6).to_numpy(), table.num_rows
            bits = np.frombuffer(b"".join(table.column(7).to_pylist()), np.uint64).reshape(n, -1)
            if n < 2:
                continue
            new = (np.diff(bucket) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)
            edge, run_edge = np.append(np.flatnonzero(new) + 1, n), np.append(np.flatnonzero(new | (np.diff(block) != 0)) + 1, n)
            ends, run_ends = np.repeat(edge, np.diff(edge, prepend=0)), np.repeat(run_edge, np.diff(run_edge, prepend=0))
            begin = np.where(i == j, np.arange(n) + 1, np.where(block == i, run_ends, ends))
            count = ends - begin
            upto, left, at = np.cumsum(count), np.zeros(n, bool), 0
            while at < n:
                to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIRS, side="right")))
                a, b = np.repeat(np.arange(at, to), count[at:to]), _ranges(begin[at:to], count[at:to])
                at = to
                differ = np.zeros(len(a), np.int64)
                for k in range(bits.shape[1]):
                    differ += np.bitwise_count(bits[a, k] ^ bits[b, k])
                good = (differ <= most) & (fresh[a] | fresh[b])
                left[a[good]] = left[b[good]] = True
            if left.any():
                yield from table.select([0, 3, 5, 6]).filter(pa.array(left)).to_batches()

    return run


def _looks(hashes: int, threshold: float) -> tuple[list[int], list[int]]:
    looks = [n for n in (32, 64, 128) if n < hashes] + [hashes]
    return looks, [fewest_matches(n, threshold) for n in looks]


def _prune(bands: int, per_band: int, threshold: float):
    """The texts of each group that have a candidate left."""

    def run(batches):
        looks, need = _looks(bands * per_band, threshold)
        for table in _groups(batches):
            left = np.zeros(table.num_rows, bool)
            for x, b in _pairs(table, bands, per_band, looks, need):
                left[x] = left[b] = True
            if left.any():
                yield from table.select([0, 3, 5, 7]).filter(pa.array(left)).to_batches()

    return run


def _verify(bands: int, per_band: int, threshold: float):
    """Exact similarities of each group's pairs: the least text that each one is connected with there."""

    def run(batches):
        looks, need = _looks(bands * per_band, threshold)
        for table in _groups(batches):
            keys, sets = table.column(5).to_pylist(), table.column(7).to_pylist()
            values, sizes = np.frombuffer(b"".join(sets), np.uint64), np.fromiter(map(len, sets), np.int64, len(sets)) // 8
            ends = np.cumsum(sizes)
            _, codes = np.unique(values, return_inverse=True)
            mark = np.zeros(len(values) and int(codes.max()) + 1, bool)
            root = list(range(len(keys)))

            def find(x, root=root):
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            for a, partners in _pairs(table, bands, per_band, looks, need):
                mine = codes[ends[a] - sizes[a] : ends[a]]
                mark[mine] = True
                for b in partners.tolist():
                    p, q = find(a), find(b)
                    if p == q:
                        continue  # connected already
                    common = int(np.count_nonzero(mark[codes[ends[b] - sizes[b] : ends[b]]]))
                    if common >= threshold * (sizes[a] + sizes[b] - common) - 1e-9:
                        low, high = (p, q) if keys[p] < keys[q] else (q, p)
                        root[high] = low
                mark[mine] = False
            linked = [(keys[x], keys[find(x)]) for x in range(len(keys)) if find(x) != x]
            if linked:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*linked, strict=True)], ["u", "v"])

    return run


def _in_blocks(placed: DataFrame, *more: str) -> DataFrame:
    """Rows (bucket, i, j, band, block, key, fresh, more), once for each pair of blocks of the bucket that a row is in.

    Fresh texts are in the first ``blocks`` blocks, the others in ``others`` more. Two blocks meet where one is fresh.
    """
    deal = lambda n: F.pmod(F.xxhash64("key", "bucket"), F.greatest(n, F.lit(1)).cast("long")).cast("int")
    mine = F.when(F.col("fresh"), deal(F.col("blocks"))).otherwise(F.col("blocks") + deal(F.col("others")))
    met = F.sequence(F.lit(0), F.col("blocks") + F.when(F.col("fresh"), F.col("others")).otherwise(0) - 1)
    dealt = placed.where("blocks > 0").select("bucket", "band", "key", "fresh", *more, mine.alias("block"), F.explode(met).alias("with"))
    return dealt.select("bucket", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "band", "block", "key", "fresh", *more)


@dataclass(frozen=True)
class Bands:
    """How texts are compared: a pair at ``threshold`` 0.7 meets in none of 64 bands of 4 with a probability of 2e-8."""

    threshold: float = 0.7
    words: int = 3
    bands: int = 64
    per_band: int = 4
    block: int = 1024
    block_bytes: int = 8 << 20
    #: Groups of at most so many blocks are compared whole.
    whole_blocks: int = 8

    def sketch(self, rows: DataFrame, group: str, row: str) -> DataFrame:
        """(group, row, key, sig) of ``keyed_texts``."""
        signed = T.StructType([rows.schema[group], rows.schema[row], T.StructField("key", T.BinaryType()), T.StructField("sig", T.BinaryType())])
        return rows.select(group, row, "key", F.xxhash64(group).alias("seed"), "words").mapInArrow(_sketch(self.words, self.bands * self.per_band), signed)

    def banded(self, sketches: DataFrame) -> DataFrame:
        """(bucket, band, key, bits): a row for each band."""
        return sketches.select("key", "sig").mapInArrow(_bands(self.bands, self.per_band), "bucket long, band int, key binary, bits binary")

    def bits(self, sketches: DataFrame) -> DataFrame:
        """``sig``, the last column, becomes ``bits``: one bit of each hash."""
        out = T.StructType([*sketches.schema.fields[:-1], T.StructField("bits", T.BinaryType())])
        return sketches.mapInArrow(_bits(self.bands * self.per_band), out)

    def sets(self, texts: DataFrame) -> DataFrame:
        """(key, set) of (key, seed, words)."""
        return texts.select("key", "seed", "words").mapInArrow(_sets(self.words), "key binary, set binary")

    def sketched_sets(self, texts: DataFrame) -> DataFrame:
        """(key, sig, set) of (key, seed, words)."""
        return texts.select("key", "seed", "words").mapInArrow(_sketched_sets(self.words, self.bands * self.per_band), "key binary, sig binary, set binary")

    def links(self, placed: DataFrame, sketches: DataFrame, sets_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Verified links (u, v) that connect what is similar in the buckets of ``placed`` (bucket, band, key, bits, fresh).

        Pairs without a fresh text are not looked at. ``sets_of`` gives (key, set) of the keys it is asked for.
        """
        need = lambda c: F.ceil(c / self.block).cast("int")
        fresh = F.when(F.col("fresh"), 1)
        blocks = [need(F.count(fresh)).alias("blocks"), need(F.count(F.lit(1)) - F.count(fresh)).alias("others"), F.count(F.lit(1)).alias("n")]
        # Only large buckets are cut; one of a block's size is one group, whether its texts are fresh or not.
        large = written(placed.groupBy("bucket", "band").agg(*blocks).where(f"n > {self.block} and blocks > 0").drop("n"), "large")
        sized = placed.join(large, ["bucket", "band"], "left")
        alone = sized.where("blocks is null").select("bucket", F.lit(0).alias("i"), F.lit(0).alias("j"), "band", F.lit(0).alias("block"), "key", "fresh", "bits")
        cut = alone if large.isEmpty() else alone.unionByName(_in_blocks(sized.where("blocks is not null"), "bits"))
        met = cut.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "block")
        near = written(met.mapInArrow(_near(self.bands * self.per_band, self.threshold), "bucket long, band int, key binary, fresh boolean").distinct(), "near")
        # Written apart: the join then has an exchange on both sides, and Spark can split a bucket of very many texts.
        sizes = written(near.groupBy("bucket", "band").agg(*blocks).where("n > 1 and blocks > 0").drop("n"), "blocks")
        met = _in_blocks(near.join(sizes, ["bucket", "band"])).join(sketches.select("key", "sig"), "key")
        met = met.select("bucket", "i", "j", "band", "block", "key", "sig", "fresh").repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
        left = written(met.mapInArrow(_prune(self.bands, self.per_band, self.threshold), "bucket long, band int, key binary, fresh boolean").distinct(), "candidates")
        # The keys grow with the input: never broadcast.
        needed = left.select("key").distinct().hint("merge")
        sets = written(sets_of(needed).join(sketches.select("key", "sig"), "key"), "sets")
        sized = left.join(sets.select("key", F.octet_length("set").cast("long").alias("bytes")), "key").groupBy("bucket", "band")
        most = lambda n, size: F.greatest(F.ceil(n / self.block), F.ceil(F.coalesce(size, F.lit(0)) / self.block_bytes)).cast("int")
        old = F.when(~F.col("fresh"), F.col("bytes"))
        sized = sized.agg(most(F.count(fresh), F.sum(fresh * F.col("bytes"))).alias("blocks"), most(F.count(old), F.sum(old)).alias("others"))
        dealt = _in_blocks(left.join(written(sized, "blocks"), ["bucket", "band"])).join(sets, "key")
        dealt = dealt.select("bucket", "i", "j", "band", "block", "key", "sig", "set").repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
        return written(dealt.mapInArrow(_verify(self.bands, self.per_band, self.threshold), "u binary, v binary"), "links")

    def all_links(self, sketches: DataFrame, sets_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Links that connect all similar texts of (key, seed, sig); texts of one group have one seed."""
        sized = written(sketches.groupBy("seed").agg((F.count(F.lit(1)) > self.block * self.whole_blocks).alias("banded")), "groups")
        whole = sketches.join(sized.where("not banded"), "seed").select(F.col("seed").alias("bucket"), F.lit(-1).alias("band"), "key", "sig")
        whole = self.bits(whole).withColumn("fresh", F.lit(True))
        if sized.where("banded").isEmpty():
            return self.links(whole, sketches, sets_of)
        banded = self.banded(sketches.join(sized.where("banded"), "seed"))
        large = written(banded.groupBy("bucket", "band").agg(F.ceil(F.count(F.lit(1)) / self.block).cast("int").alias("pieces")).where("pieces > 1"), "large-buckets")
        if large.isEmpty():
            return self.links(whole.unionByName(banded.withColumn("fresh", F.lit(True))), sketches, sets_of)
        both = banded.join(large, ["bucket", "band"], "left")
        cut = F.col("pieces").isNotNull()
        piece = F.xxhash64("bucket", F.pmod(F.xxhash64("key", "bucket"), F.col("pieces").cast("long")))
        small = both.select(F.when(cut, piece).otherwise(F.col("bucket")).alias("bucket"), F.when(cut, -1).otherwise(F.col("band")).alias("band"), "key", "bits", F.lit(True).alias("fresh"))
        first = self.links(whole.unionByName(small), sketches, sets_of)
        parts = components(first).withColumnRenamed("node", "key")
        rest = written(both.where(cut).select("bucket", "band", "key", "bits").join(parts, "key", "left").select("bucket", "band", "key", "bits", F.coalesce("component", "key").alias("part")), "parts")
        counted = rest.groupBy("bucket", "band", "part").agg(F.count(F.lit(1)).alias("n"))
        largest = counted.groupBy("bucket", "band").agg(F.max_by("part", "n").alias("largest"), F.count(F.lit(1)).alias("parts")).where("parts > 1").drop("parts")
        rest = rest.join(written(largest, "largest"), ["bucket", "band"]).select("bucket", "band", "key", "bits", (F.col("part") != F.col("largest")).alias("fresh"))
        return first.unionByName(self.links(rest, sketches, sets_of))


def cluster(df: DataFrame, *, group: str, row: str, text: str, threshold: float = 0.7, words: int = 3, bands: int = 64, per_band: int = 4, block: int = 1024, block_bytes: int = 8 << 20, whole_blocks: int = 8) -> DataFrame:
    """(group, row, cluster): the cluster is the least row connected with it by similarities of ``threshold`` or more.

    Texts of a group of at most ``block * whole_blocks`` different ones all meet. In a larger group, a pair at 0.7 meets in
    none of 64 bands of 4 with a probability of 2e-8. Comparing bits or signatures loses a pair with 1e-9 a look; what is
    linked is exact. Rows without a word are clusters of their own.
    """
    how = Bands(threshold, words, bands, per_band, block, block_bytes, whole_blocks)
    rows = keyed_texts(df, group=group, row=row, text=text)
    members = written(how.sketch(rows, group, row), "members")
    # One row stands for each text; only the texts that still have a candidate are read again.
    one = [F.first(F.xxhash64(group)).alias("seed"), F.first("sig").alias("sig"), F.first(group).alias("of_group"), F.min(row).alias("least")]
    sketches = written(members.groupBy("key").agg(*one), "sketches")

    def sets_of(needed: DataFrame) -> DataFrame:
        wanted = sketches.join(needed, "key").select(F.col("of_group").alias(group), F.col("least").alias(row))
        again = keyed_texts(df.select(group, row, text).join(wanted, [group, row], "left_semi"), group=group, row=row, text=text)
        return how.sets(again.groupBy("key").agg(F.first(F.xxhash64(group)).alias("seed"), F.first("words").alias("words")))

    parents = components(how.all_links(sketches, sets_of))
    least = sketches.select("key", "least").join(parents.withColumnRenamed("node", "key"), "key", "left")
    classes = written(least.withColumn("component", F.coalesce("component", "key")), "classes")
    named = classes.groupBy("component").agg(F.min("least").alias("cluster"))
    per_key = classes.join(named, "component").select("key", "cluster")
    clustered = members.join(per_key, "key").select(group, row, "cluster")
    others = df.where(F.col(group).isNull() | F.col(row).isNull() | ~F.coalesce(F.col(text), F.lit("")).rlike(r"\S"))
    return clustered.unionByName(others.select(group, row, F.col(row).alias("cluster")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of ``edges(u, v)``: every node learns the least node that it can reach.

    Each round takes the least label of the neighbours, then the label of that label, so rounds grow with the
    logarithm of a chain's length. Rounds are written to the shared folder.
    """
    both = written(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    labels = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("label")).select(F.col("u").alias("node"), "label"), "labels")
    while True:
        heard = both.join(labels.select(F.col("node").alias("v"), F.col("label").alias("heard")), "v").groupBy(F.col("u").alias("node")).agg(F.min("heard").alias("heard"))
        step = labels.join(heard, "node").select("node", "label", F.least("label", "heard").alias("near"))
        jump = labels.select(F.col("node").alias("near"), F.col("label").alias("far"))
        new = step.join(jump, "near", "left").select("node", "label", F.least("near", F.coalesce("far", "near")).alias("next"))
        new = written(new, "labels")
        changed = not new.where(F.col("label") != F.col("next")).isEmpty()
        labels = new.select("node", F.col("next").alias("label"))
        if not changed:
            return labels.withColumnRenamed("label", "component")
