"""N-gram Jaccard join of documents, with Bayesian pruning of candidates.

Equal texts form one class and go on as one. Each class has a MinHash signature of one byte a hash; bands of it give
candidate buckets. Inside a bucket, signatures are compared piece by piece: after each piece the posterior
probability that the pair's similarity reaches the threshold (uniform prior) is bounded by a table, and the pair is
dropped when it falls below a tolerance. A pair that meets in several bands is handled in the first. What is left is
verified exactly on the shingle sets.

Buckets are split into blocks, and blocks meet in pairs, so no task holds more than two blocks whatever a bucket's
size. Comparing signatures gives only the classes of a bucket that still have a candidate there: a row each, however
many partners it has. These alone get their shingle hashes and are dealt out anew, in blocks bounded by bytes; the same
comparison then gives the pairs again, inside the task, which verifies them and returns each class's number of links
and the least class it is connected with there. These few links give the classes' connected components.

Numbers of links ask for all pairs of a family: compute grows with the square of its size, and so do the rows that
blocks exchange, by a factor that is less by the size of a block. ``keep_one`` needs no numbers. There a large bucket is
first cut into small ones by a hash, other ones in every band, which connects a family by rows in proportion to its
size; of the buckets that then still hold several components, the classes outside the largest meet each other and
those of the largest. The components are the same.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import byte_texts, coded_words, materialize, mix64, pieces, ranges, segment_sums, starts_of, text_of
from .components import connected_components

#: Words a shingle, and the similarity of a link.
SHINGLE, THRESHOLD = 5, 0.8
#: Bands of the signature and hashes a band: a pair at the threshold meets in no band with a probability of 5e-6.
BANDS, ROWS = 40, 6
HASHES = BANDS * ROWS
#: Hashes compared before each look at the posterior, and the probability below which a pair is dropped.
LOOKS, TOLERANCE = (32, 64, 128, HASHES), 1e-6
#: Classes of a block, and bytes of shingle hashes of a block that is verified. A bucket of more than ``SPREAD`` blocks has
#: larger ones, up to eight times, before it has more.
BLOCK, BLOCK_BYTES, SPREAD = 256, 8 << 20, 16
#: Pairs compared at once in a task: two signatures each, and a mark for each of their bytes.
PAIRS = 40_000
#: Buckets from here on are pieces of large ones, in which pairs are compared in whatever band they meet.
PIECE = 1 << 62
#: Rows of one text are dealt into so many parts where they meet their class.
SALTS = 256
_P = np.uint64(0x100000001B3)
#: Factors and summands of the orders: independent for each, as bands and posterior assume.
_A, _B = mix64(np.arange(2 * HASHES, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x5851F42D4C957F2D)).reshape(2, HASHES) | np.array([[1], [0]], np.uint64)


def shingle_hashes(texts: list[bytes], n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each run of ``n`` words of the texts, and their number for each text.

    A text of fewer words, but at least one, has one shingle of all its words; one without a word has none.
    """
    import xxhash

    codes, distinct, counts = coded_words(texts)
    table = np.array([xxhash.xxh3_64_intdigest(w) for w in distinct.cast(pa.large_binary()).to_pylist()], np.uint64)
    words = table[codes] if len(codes) else np.empty(0, np.uint64)
    sizes = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    begin = ranges(starts_of(counts)[:-1], sizes)
    length = np.repeat(np.minimum(counts, n), sizes)
    out = length.astype(np.uint64)
    for k in range(n):
        use = k < length
        out[use] = out[use] * _P + mix64(words[begin[use] + k])
        out = mix64(out)
    return out, sizes


def signatures(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A row of ``HASHES`` bytes for each text with a shingle (``sizes`` > 0).

    The k-th order of shingles sorts by their hash * a[k] + b[k], modulo 2 ** 64, with fixed random a[k] (odd) and b[k].
    """
    sizes = sizes[sizes > 0]
    out = np.empty((len(sizes), HASHES), np.uint8)
    if not len(sizes):
        return out
    first = starts_of(sizes)[:-1]
    value = np.empty_like(hashes)
    for k in range(HASHES):
        np.multiply(hashes, _A[k], out=value)
        value += _B[k]
        least = np.minimum.reduceat(value, first)
        out[:, k] = mix64(least) >> np.uint64(56)
    return out


def fewest_matches(looks: tuple[int, ...] = LOOKS, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[int]:
    """For each look, the fewest equal bytes with which the posterior of reaching the threshold meets the tolerance."""
    grid = (np.arange(20_000) + 0.5) / 20_000
    p = grid + (1 - grid) / 256  # bytes of different shingles agree by chance
    out = []
    for n in looks:
        for m in range(n + 1):
            log = m * np.log(p) + (n - m) * np.log1p(-np.minimum(p, 1 - 1e-12))
            weight = np.exp(log - log.max())
            if weight[grid >= threshold].sum() >= tolerance * weight.sum():
                break
        out.append(m)
    return out


def _sketch(batches):
    for batch in pieces(batches, "text"):
        hashes, sizes = shingle_hashes(byte_texts(batch, "text"))
        found = signatures(hashes, sizes)
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(sizes > 0)), pa.array([x.tobytes() for x in found], pa.binary())], ["key", "sig"])


def _bands(batches):
    """A bucket number for each band: the band, and 48 bits that are exactly its bytes."""
    for batch in batches:
        n = batch.num_rows
        sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(n, BANDS, ROWS).astype(np.int64)
        value = np.zeros((n, BANDS), np.int64)
        for k in range(ROWS):
            value = value << 8 | sig[:, :, k]
        bucket = value | (np.arange(BANDS, dtype=np.int64) << 48)
        yield pa.RecordBatch.from_arrays([pa.array(bucket.ravel()), batch.column(0).take(pa.array(np.repeat(np.arange(n), BANDS)))], ["bucket", "key"])


def _whole_groups(batches, columns: int):
    """Tables of whole groups from rows sorted by the first ``columns`` columns."""
    held = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        same = np.ones(batch.num_rows, bool)
        for c in range(columns):
            values = batch.column(c).to_numpy()
            same &= values == values[-1]
        last = batch.num_rows - int(same[::-1].argmin() if not same.all() else batch.num_rows)
        if last:
            held[-1] = batch.slice(0, last)
            yield pa.Table.from_batches(held).combine_chunks()
            held = [batch.slice(last)]
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _edges(bucket: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Where a new group begins."""
    return np.flatnonzero((np.diff(bucket) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)) + 1


def _candidates(bucket: np.ndarray, i: np.ndarray, j: np.ndarray, block: np.ndarray, sig: np.ndarray, need: list[int]):
    """Pairs of rows of one group whose signatures agree often enough, in the first band in which they meet.

    Rows are sorted by group and block: in a pair of two blocks, the second's rows end the group.
    """
    n = len(bucket)
    edge = _edges(bucket, i, j)
    ends = np.repeat(np.append(edge, n), np.diff(np.concatenate([[0], edge, [n]])))
    other = np.flatnonzero(np.concatenate([[True], (np.diff(bucket) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0) | (np.diff(block) != 0)]))
    run_end = np.repeat(np.append(other[1:], n), np.diff(np.append(other, n)))
    begin = np.where(i == j, np.arange(n) + 1, np.where(block == i, run_end, ends))
    count = ends - begin
    upto = np.cumsum(count)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIRS, side="right")))
        rows = np.arange(at, to)
        a, b = np.repeat(rows, count[rows]), ranges(begin[rows], count[rows])
        at = to
        matches, done = np.zeros(len(a), np.int64), 0
        for look, least in zip(LOOKS, need, strict=True):
            matches += (sig[a, done:look] == sig[b, done:look]).sum(1)
            done = look
            good = matches >= least
            a, b, matches = a[good], b[good], matches[good]
        if not len(a):
            continue
        # The first band in which a pair meets handles it.
        equal = (sig[a] == sig[b]).reshape(len(a), BANDS, ROWS).all(2)
        mine = (equal.argmax(1) == (bucket[a] >> 48)) | (bucket[a] >= PIECE)
        if mine.any():
            yield a[mine], b[mine]


def _signed(table: pa.Table, column: int) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(column).to_pylist()), np.uint8).reshape(table.num_rows, HASHES)


def _prune(tolerance: float, threshold: float):
    """The rows of each group that have a candidate left."""

    def run(batches):
        need = fewest_matches(LOOKS, threshold, tolerance)
        for table in _whole_groups(batches, 3):
            bucket, i, j, block = (table.column(c).to_numpy() for c in range(4))
            left = np.zeros(len(bucket), bool)
            for a, b in _candidates(bucket, i, j, block, _signed(table, 5), need):
                left[a] = left[b] = True
            if left.any():
                yield from table.select([0, 4, 6]).filter(pa.array(left)).to_batches()
            del table
            pa.default_memory_pool().release_unused()

    return run


def _hashed(batches):
    """Distinct shingle hashes of each text, ascending, as bytes."""
    for batch in pieces(batches, "text"):
        hashes, sizes = shingle_hashes(byte_texts(batch, "text"))
        at = starts_of(sizes)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([np.unique(hashes[a:b]).tobytes() for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())], ["key", "hashes"])


def _verify(tolerance: float, threshold: float):
    """Exact similarities of each group's pairs: links of each class, and the least class it is connected with."""

    def run(batches):
        need = fewest_matches(LOOKS, threshold, tolerance)
        for table in _whole_groups(batches, 3):
            bucket, i, j, block = (table.column(c).to_numpy() for c in range(4))
            edge = _edges(bucket, i, j)
            sig = _signed(table, 5)
            out: tuple[list, list, list] = ([], [], [])
            for s, e in zip([0, *edge.tolist()], [*edge.tolist(), len(bucket)], strict=True):
                keys, sets = table.column(4).slice(s, e - s).to_pylist(), table.column(6).slice(s, e - s).to_pylist()
                size = np.fromiter(map(len, sets), np.int64, len(sets)) // 8
                at = starts_of(size)
                whole = np.frombuffer(b"".join(sets), np.uint64)
                del sets
                codes = np.unique(whole, return_inverse=True)[1]
                del whole
                mark = np.zeros(int(codes.max(initial=-1)) + 1, bool)
                links, root = np.zeros(e - s, np.int64), list(range(e - s))

                def find(x, root=root):
                    while root[x] != x:
                        root[x] = root[root[x]]
                        x = root[x]
                    return x

                for first, second in _candidates(bucket[s:e], i[s:e], j[s:e], block[s:e], sig[s:e], need):
                    starts = np.flatnonzero(np.diff(first, prepend=-1))
                    for a, partners in zip(first[starts].tolist(), np.split(second, starts[1:]), strict=True):
                        mine = codes[at[a] : at[a + 1]]
                        mark[mine] = True
                        common = segment_sums(mark[codes[ranges(at[partners], size[partners])]].astype(np.int64), size[partners])
                        mark[mine] = False
                        linked = partners[common >= threshold * (size[a] + size[partners] - common) - 1e-9]
                        links[a] += len(linked)
                        links[linked] += 1
                        for x in linked.tolist():
                            p, q = find(a), find(x)
                            if p != q:
                                low, high = (p, q) if keys[p] < keys[q] else (q, p)
                                root[high] = low
                for x in np.flatnonzero(links).tolist():
                    out[0].append(keys[x])
                    out[1].append(int(links[x]))
                    out[2].append(keys[find(x)])
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())], ["key", "links", "root"])
            del table
            pa.default_memory_pool().release_unused()

    return run


def _in_blocks(placed: DataFrame) -> DataFrame:
    """Rows (bucket, i, j, block, key, fresh) in a random block of their bucket, once for each pair of blocks it is in.

    Fresh classes are in the first ``blocks`` blocks, the others in ``others`` more. Two blocks meet where one is fresh.
    """
    deal = lambda n: F.pmod(F.xxhash64("key", "bucket"), F.greatest(n, F.lit(1)).cast("long")).cast("int")
    mine = F.when(F.col("fresh"), deal(F.col("blocks"))).otherwise(F.col("blocks") + deal(F.col("others")))
    met = F.sequence(F.lit(0), F.col("blocks") + F.when(F.col("fresh"), F.col("others")).otherwise(0) - 1)
    dealt = placed.where("blocks > 0").select("bucket", "key", "fresh", mine.alias("block"), F.explode(met).alias("with"))
    return dealt.select("bucket", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "block", "key", "fresh")


def _grouped(df: DataFrame) -> DataFrame:
    return df.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "block")


def similar_documents(docs: DataFrame, *, threshold: float = THRESHOLD, tolerance: float = TOLERANCE, block: int = BLOCK, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row for each document: doc_id, class_id, n_links, n_copies, text_key.

    Documents of equal text share ``text_key``; ``n_copies`` counts them, itself included. ``n_links`` is the number
    of different texts with a Jaccard similarity of at least ``threshold`` on sets of five-word shingles. ``class_id``
    is the least doc_id of all documents connected by links or equal texts. A text of one to four words is one
    shingle; texts without a word link with nothing and are only copies of equal texts (null counts as empty). A null
    doc_id is never the least unless a class has no other. Other columns are not read.
    """
    return _classes(docs, threshold, tolerance, block, block_bytes).drop("component")


def _blocks(n: Column, block: int) -> Column:
    """Blocks of a bucket of ``n`` classes."""
    return F.greatest(F.ceil(n / (8 * block)), F.least(F.ceil(n / block), F.lit(SPREAD).cast("long"))).cast("int")


def _links(placed: DataFrame, sketches: DataFrame, rows: DataFrame, tolerance: float, threshold: float, block: int, block_bytes: int) -> DataFrame:
    """(key, links, root) of the similar classes in the buckets of ``placed`` (bucket, key, fresh), where one is fresh."""
    fresh, every = F.count_if("fresh"), F.count(F.lit(1))
    sizes = placed.groupBy("bucket").agg(_blocks(fresh, block).alias("blocks"), _blocks(every - fresh, block).alias("others"), every.alias("n")).where("n > 1 and blocks > 0").drop("n")
    # Written apart: the join then has an exchange on both sides, and Spark can split a bucket of very many classes.
    sizes = materialize(sizes, "bucket-blocks")
    met = _in_blocks(placed.join(sizes, "bucket")).join(sketches, "key").select("bucket", "i", "j", "block", "key", "sig", "fresh")
    left = _grouped(met).mapInArrow(_prune(tolerance, threshold), "bucket long, key binary, fresh boolean").distinct()
    left = materialize(left, "candidates")

    # The keys grow with the input: never broadcast.
    needed = left.select("key").distinct().hint("merge")
    # One text a class, chosen before the shuffle: a class of very many copies does not meet in one task.
    texts = rows.groupBy("key").agg(F.first("text").alias("text")).join(needed, "key", "left_semi")
    sets = materialize(texts.mapInArrow(_hashed, "key binary, hashes binary").join(sketches, "key"), "shingles")
    sized = left.join(sets.select("key", F.octet_length("hashes").cast("long").alias("bytes")), "key")
    least = lambda n, size: F.greatest(_blocks(n, block), F.ceil(F.coalesce(F.sum(size), F.lit(0)) / block_bytes)).cast("int")
    sized = sized.groupBy("bucket").agg(least(fresh, F.when(F.col("fresh"), F.col("bytes"))).alias("blocks"), least(every - fresh, F.when(~F.col("fresh"), F.col("bytes"))).alias("others"))
    dealt = _in_blocks(left.join(materialize(sized, "verified-blocks"), "bucket"))
    dealt = _grouped(dealt.join(sets, "key").select("bucket", "i", "j", "block", "key", "sig", "hashes"))
    return materialize(dealt.mapInArrow(_verify(tolerance, threshold), "key binary, links long, root binary"), "links")


def _connecting_links(banded: DataFrame, sketches: DataFrame, rows: DataFrame, tolerance: float, threshold: float, block: int, block_bytes: int) -> DataFrame:
    """(u, v): links that connect what is similar, without counting all of them."""
    edges = lambda links: links.select(F.col("key").alias("u"), F.col("root").alias("v"))
    params = (sketches, rows, tolerance, threshold, block, block_bytes)
    most = 4 * block
    large = materialize(banded.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("pieces")).where("pieces > 1"), "large-buckets")
    if large.isEmpty():
        return edges(_links(banded.withColumn("fresh", F.lit(True)), *params))
    both = banded.join(large, "bucket", "left")
    cut = F.col("pieces").isNotNull()
    piece = F.xxhash64("bucket", F.pmod(F.xxhash64("key", "bucket"), F.col("pieces").cast("long"))).bitwiseAND(F.lit(PIECE - 1)).bitwiseOR(F.lit(PIECE))
    first = edges(_links(both.select(F.when(cut, piece).otherwise(F.col("bucket")).alias("bucket"), "key", F.lit(True).alias("fresh")), *params))
    parts = connected_components(first).withColumnRenamed("node", "key")
    rest = materialize(both.where(cut).select("bucket", "key").join(parts, "key", "left").select("bucket", "key", F.coalesce("component", "key").alias("part")), "parts")
    counted = rest.groupBy("bucket", "part").agg(F.count(F.lit(1)).alias("n"))
    largest = counted.groupBy("bucket").agg(F.max_by("part", "n").alias("largest"), F.count(F.lit(1)).alias("parts")).where("parts > 1").drop("parts")
    rest = rest.join(materialize(largest, "largest-parts"), "bucket").select("bucket", "key", (F.col("part") != F.col("largest")).alias("fresh"))
    return first.unionByName(edges(_links(rest, *params)))


def _classes(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE, block: int = BLOCK, block_bytes: int = BLOCK_BYTES, counted: bool = True) -> DataFrame:
    """``similar_documents`` with the class's own key, ``component``; numbers of links only where ``counted``."""
    rows = docs.select("doc_id", F.unhex(F.md5(text_of())).alias("key"), text_of().alias("text"))
    sketches = rows.select("key", "text").mapInArrow(_sketch, "key binary, sig binary")
    sketches = materialize(sketches.groupBy("key").agg(F.first("sig").alias("sig")), "sketches")
    banded = sketches.mapInArrow(_bands, "bucket long, key binary")
    if counted:
        links = _links(banded.withColumn("fresh", F.lit(True)), sketches, rows, tolerance, threshold, block, block_bytes)
        edges = links.select(F.col("key").alias("u"), F.col("root").alias("v"))
    else:
        edges = _connecting_links(banded, sketches, rows, tolerance, threshold, block, block_bytes)
        links = edges.select(F.explode(F.array("u", "v")).alias("key"), F.lit(None).cast("long").alias("links"))

    members = connected_components(edges)
    counts = links.groupBy("key").agg(F.sum("links").alias("n_links"))
    linked = counts.join(members.withColumnRenamed("node", "key"), "key").select("key", "n_links", "component")
    # Rows of one text are dealt into parts, and its class has a row for each part that there is.
    ids = rows.select("doc_id", "key", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("short").alias("part"))
    copies = ids.groupBy("key", "part").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n"))
    copies = copies.groupBy("key").agg(F.min("least").alias("least"), F.sum("n").alias("n_copies"), F.collect_list("part").alias("parts"))
    classes = materialize(copies.join(linked, "key", "left").withColumn("component", F.coalesce("component", "key")), "classes")
    named = classes.groupBy("component").agg(F.min("least").alias("class_id"))
    per_key = classes.join(named, "component").select("key", F.explode("parts").alias("part"), "component", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), "n_copies")
    return ids.join(per_key, ["key", "part"]).select("doc_id", "class_id", "n_links", "n_copies", F.lower(F.hex("key")).alias("text_key"), "component")


def keep_one(docs: DataFrame, **params) -> DataFrame:
    """One document of each class of ``similar_documents``: the one of the least doc_id, with all its columns.

    Of repeated rows with that id one stays. Documents with a null id are their class's choice only where no other is.
    """
    found = _classes(docs, **params, counted=False)
    # By the component: different classes may have the same least id.
    place = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_key"))
    chosen = found.groupBy("component").agg(F.min_by(F.struct("doc_id", "text_key"), place).alias("row")).select("row.*")
    name = "row_key"
    while name.lower() in [c.lower() for c in docs.columns]:
        name += "_"
    kept = chosen.select(_row_key(F.col("doc_id"), F.col("text_key")).alias(name))
    rows = docs.withColumn(name, _row_key(F.col("doc_id"), F.md5(text_of())))
    return rows.join(kept, name, "left_semi").dropDuplicates([name]).drop(name)


def _row_key(doc_id: Column, text_key: Column) -> Column:
    return F.md5(F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("-")), text_key))


#: The same classes and links by comparing all texts that share a shingle.
ORACLE_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS text, md5(coalesce(text, '')) AS k FROM documents),
w AS (SELECT k, list_filter(regexp_split_to_array(any_value(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS p FROM d GROUP BY k),
s AS (SELECT k, list_distinct(CASE WHEN len(p) < 5 THEN [array_to_string(p, ' ')] ELSE list_transform(range(1, len(p) - 3),
  lambda i: p[i] || ' ' || p[i + 1] || ' ' || p[i + 2] || ' ' || p[i + 3] || ' ' || p[i + 4]) END) AS g FROM w WHERE len(p) > 0),
x AS (SELECT k, len(g) AS n, unnest(g) AS h FROM s),
pairs AS (SELECT a.k AS a, b.k AS b FROM x a JOIN x b ON a.h = b.h AND a.k < b.k GROUP BY a.k, b.k, a.n, b.n HAVING 5 * count(*) >= 4 * (a.n + b.n - count(*))),
edges AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
reach AS (SELECT k AS node, k AS other FROM w UNION SELECT reach.node, edges.b FROM reach JOIN edges ON reach.other = edges.a),
least AS (SELECT node, min(doc_id) AS class_id FROM reach JOIN d ON d.k = reach.other GROUP BY node),
copies AS (SELECT k, count(*) AS n_copies FROM d GROUP BY k),
degree AS (SELECT a AS k, count(*) AS n_links FROM edges GROUP BY a)
SELECT doc_id, class_id, coalesce(n_links, 0) AS n_links, n_copies, d.k AS text_key
FROM d JOIN least ON least.node = d.k JOIN copies ON copies.k = d.k LEFT JOIN degree ON degree.k = d.k
"""
