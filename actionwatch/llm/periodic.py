"""Periodic runs of words, by seeds on diagonals.

A run of period q and length of at least ``max(6, 4q)`` is equal to itself moved by q over at least 3q words (5, for
q = 1). Lags are handled in classes of 2^j to 2^(j+1) - 1; the least overlap that a class guarantees is its gram length,
5, 6, 12, 24 ..., which is never below the lag. Grams are indexed by name: a gram of 2p words is named by the names of
its two halves, so equal names are equal words, and a gram that occurs once in its document leaves the index together
with all longer ones that hold it. Inside a run the next occurrence of a gram stands one smallest period on (else the
period would divide further), so next occurrences at a lag of the class are all the pairs that are needed, and their
number is linear.

Each pair is a seed on the diagonal of its lag. Seeds go in order of place; one below the furthest place covered at its
lag lies in a stretch that has been extended already. Others are extended to both sides, a doubling number of words
at once, and what is long enough is a run. No run is found at a multiple of its smallest period: its grams would
occur earlier.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_texts, coded_words, pieces, starts_of, text_of

RUN = "array<struct<start:long,length:long,period:long>>"
RUN_STRUCT = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
#: A run has at least so many words, and so many periods.
LEAST, PERIODS = 6, 4


def _repeated(pos: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose key occurs more than once, and a number for each such key."""
    _, name, count = np.unique(key, return_inverse=True, return_counts=True)
    keep = count[name] > 1
    return pos[keep], name[keep]


def _pair(pos: np.ndarray, name: np.ndarray, shift: int, length: int, ends: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of grams of ``length`` words inside their document, and a key of the two names that cover each of them."""
    fits = pos + length <= ends[pos]
    table[pos] = name
    other = table[pos[fits] + shift]
    table[pos] = -1
    pos, name = pos[fits], name[fits]
    here = other >= 0
    return pos[here], name[here] * len(table) + other[here]


def _extend(codes: np.ndarray, at: int, lag: int, low: int, high: int) -> tuple[int, int]:
    """The longest stretch around ``at`` between ``low`` and ``high`` where words equal those ``lag`` on."""
    start, step = at, 16
    while start > low:
        n = min(step, start - low)
        differ = np.flatnonzero(codes[start - n : start] != codes[start - n + lag : start + lag])
        start -= n - 1 - int(differ[-1]) if len(differ) else n
        if len(differ):
            break
        step *= 2
    end, step = at, 16
    while end < high:
        n = min(step, high - end)
        differ = np.flatnonzero(codes[end : end + n] != codes[end + lag : end + n + lag])
        end += int(differ[0]) if len(differ) else n
        if len(differ):
            break
        step *= 2
    return start, end


def find_runs(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Rows (place among all words, length, period), ordered, of all runs inside documents of ``counts`` words each."""
    begin = starts_of(counts)
    owner = np.repeat(np.arange(len(counts)), counts)
    ends, lows = begin[1:][owner], begin[:-1][owner]
    table = np.full(len(codes), -1, np.int64)
    found, size, lag = [], 1, 1
    pos, name = _repeated(np.arange(len(codes)), owner * (int(codes.max()) + 1) + codes) if len(codes) else (codes, codes)
    while len(pos) and PERIODS * lag <= counts.max():
        gram = max(LEAST, PERIODS * lag) - lag
        while len(pos) and 2 * size <= gram:
            pos, name = _repeated(*_pair(pos, name, size, 2 * size, ends, table))
            size *= 2
        at, key = _pair(pos, name, gram - size, gram, ends, table)
        order = np.lexsort((at, key))
        at, key = at[order], key[order]
        lags = at[1:] - at[:-1]
        seed = (key[1:] == key[:-1]) & (lags >= lag) & (lags < 2 * lag)
        at, lags = at[:-1][seed], lags[seed]
        order = np.lexsort((at, lags))
        at, lags = at[order], lags[order]
        # A seed right behind another of its lag is on the same stretch.
        first = np.ones(len(at), bool)
        first[1:] = (lags[1:] != lags[:-1]) | (at[1:] != at[:-1] + 1)
        furthest: dict[int, int] = {}
        for i, q in zip(at[first].tolist(), lags[first].tolist(), strict=True):
            if i < furthest.get(q, 0):
                continue
            s, e = _extend(codes, i, q, int(lows[i]), int(ends[i]) - q)
            furthest[q] = e
            if e - s + q >= max(LEAST, PERIODS * q):
                found.append((s, e - s + q, q))
        lag *= 2
    return np.array(sorted((s, q, n) for s, n, q in found), np.int64).reshape(-1, 3)[:, [0, 2, 1]]


def _collapsed(words: pa.Array, codes: np.ndarray, counts: np.ndarray, runs: np.ndarray) -> pa.Array:
    """The words that no run repeats, joined by one space for each document."""
    edge = np.zeros(len(codes) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(edge[:-1]) == 0
    sizes = starts_of(kept.astype(np.int64))[starts_of(counts)]
    lists = pa.ListArray.from_arrays(pa.array(sizes.astype(np.int32)), words.cast(pa.string()).take(pa.array(codes[kept])))
    return pc.binary_join(lists, " ")


def collapse_runs(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, runs, collapsed) of each row.

    ``runs`` are (start, length, period) by start, then period. ``collapsed`` are the words outside the repeated part
    of every run, joined by one space. A null or empty text has no words, no runs and an empty result; repeated rows
    each come out; other columns are not read. A text is one row, so a very long one takes memory in proportion.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for batch in pieces(batches, "text"):
            codes, words, counts = coded_words(byte_texts(batch, "text"))
            runs, begin = find_runs(codes, counts), starts_of(counts)
            doc = np.searchsorted(begin[1:], runs[:, 0], side="right")
            offsets = starts_of(np.bincount(doc, minlength=len(counts)))
            values = pa.StructArray.from_arrays([pa.array(runs[:, 0] - begin[doc]), pa.array(runs[:, 1]), pa.array(runs[:, 2])], fields=list(RUN_STRUCT))
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts), lists, _collapsed(words, codes, counts, runs)], ["key", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col(key).alias("key"), text_of(text).alias("text"))
    return rows.mapInArrow(run, f"key {kind}, n_words long, runs {RUN}, collapsed string").withColumnRenamed("key", key)
