"""Token counts by a compiled transducer whose chunk state maps are composed by a prefix scan.

The merges of a byte-level BPE tokenizer are compiled, as they are needed, into a deterministic transducer over
bytes. Its state after a prefix of a word holds the last token of the encoding of every shorter prefix that a later
token can still reach back to, and how many tokens that encoding has. A transition on a byte finds the one token
that ends there and is compatible with the token before it; it is annotated with the change of the token count. A
byte that begins a word of the tokenizer's own pre-splitting carries a mark and starts from the first state, whatever
the state before it. Adding the annotations along a text gives its count without building its tokens.

Every text is cut into chunks of fixed size, and all chunks of a batch run side by side, one byte a step. Where a chunk
begins, the state before it is not known yet: it is guessed by a short run-up. What a run finds is an entry of the
chunk's state map: state before -> (state after, tokens). Maps compose: the state after one chunk is looked up in the
map of the next. A prefix scan by doubling composes them along each text. Where a map lacks the state that the scan
arrives with, the chunk is run from that state, and its later neighbours from all states seen in the text; so the result
never depends on a guess.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_alphabet, byte_texts, pieces, ranges, starts_of, text_of

#: Bytes of a chunk, and of the run-up before it.
CHUNK, RUN_UP = 512, 48
#: Compiled transitions kept in a worker; beyond, the table starts anew.
TRANSITIONS = 600_000
#: Bytes of chunks that run together.
TOGETHER = 2 << 20
#: States of a text from which its unfinished chunks are run ahead of the scan.
AHEAD = 32
#: Marks are found in windows of so many bytes, with so many around them.
WINDOW, AROUND = 4 << 20, 64
OTHER, LETTER, NUMBER, SPACE = range(4)
#: What follows an apostrophe that is split off with it.
CONTRACTIONS = ["s", "t", "re", "ve", "m", "ll", "d"]


@lru_cache(maxsize=1)
def char_classes() -> np.ndarray:
    """The class of each code point."""
    out = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        out[np.frombuffer("".join(regex.findall(pattern, every)).encode("utf-32-le"), np.uint32)] = kind
    return out


def word_marks(data: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Whether a word of the pre-splitting begins at each byte; ``heads`` flags the first bytes of the parts."""
    if len(data) <= WINDOW:
        return _marks(data, heads)
    out = np.zeros(len(data), bool)
    for at in range(0, len(data), WINDOW):
        low, to = max(0, at - AROUND), min(len(data), at + WINDOW)
        out[at:to] = _marks(data[low : to + AROUND], heads[low : to + AROUND])[at - low : to - low]
    return out


def _marks(data: np.ndarray, heads: np.ndarray) -> np.ndarray:
    at = np.flatnonzero((data & 0xC0) != 0x80)
    if not len(at):
        return np.zeros(len(data), bool)
    wide = np.concatenate([data, np.zeros(3, np.uint8)])
    b = [wide[at + k].astype(np.int32) for k in range(4)]
    low = [x & 63 for x in b]
    point = np.select([b[0] < 0x80, b[0] < 0xE0, b[0] < 0xF0], [b[0], (b[0] & 31) << 6 | low[1], (b[0] & 15) << 12 | low[1] << 6 | low[2]], (b[0] & 7) << 18 | low[1] << 12 | low[2] << 6 | low[3])
    kind = char_classes()[np.minimum(point, 0x10FFFF)]
    head = heads[at]
    last = np.append(head[1:], True)  # the part's last character
    begins = head | np.append(True, kind[1:] != kind[:-1])
    # The last of a run of white space goes by itself, or, where it is a plain space, with what follows.
    single = (kind == SPACE) & ~last & np.append(kind[1:] != SPACE, False)
    begins |= single
    joined = np.flatnonzero(single & (point == 32)) + 1
    begins[joined] = False
    # An apostrophe that begins a run takes one of a few endings along; the next word begins after them.
    quote = np.flatnonzero(begins & (point == 39))
    ends = np.append(np.flatnonzero(head)[1:], len(at))
    end = ends[np.searchsorted(ends, quote, side="right")] if len(quote) else quote
    for tail in CONTRACTIONS:
        n = len(tail)
        fits = quote + n < end
        for k, c in enumerate(tail, 1):
            fits &= point[np.minimum(quote + k, len(point) - 1)] == ord(c)
        begins[quote[fits] + 1] = False
        after = quote[fits] + n + 1
        begins[after[after < end[fits]]] = True
    out = np.zeros(len(data), bool)
    out[at[begins]] = True
    return out


def require(spec: dict) -> None:
    """Raise unless the tokenizer file is of the byte-level kind that texts are cut for here."""
    cut, model = spec.get("pre_tokenizer") or {}, spec["model"]
    fits = {
        "normalizer": not spec.get("normalizer"),
        "pre-tokenizer": cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True),
        "model": model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")),
        "bytes": all(c in model["vocab"] for c in byte_alphabet()),
        "added tokens": not any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")),
    }
    if wrong := [name for name, good in fits.items() if not good]:
        raise ValueError(f"the tokenizer is of another kind: {', '.join(wrong)}")


class Transducer:
    """A lazily compiled deterministic transducer that counts BPE tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        require(spec)
        to_byte = byte_alphabet()
        special = {t["content"] for t in spec["added_tokens"]}
        # Leftmost first, the longest of those that begin at one place.
        self.special = re.compile(b"|".join(re.escape(s.encode()) for s in sorted(special, key=lambda s: (-len(s), s)))) if special else None
        raw = lambda s: bytes(to_byte[c] for c in s)
        self.ids = {raw(t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.bytes = {i: t for t, i in self.ids.items()}
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, m in enumerate(spec["model"]["merges"]):
            a, b = (raw(x) for x in (m if isinstance(m, list) else m.split(" ")))
            self.merge.setdefault((self.ids[a], self.ids[b]), (rank, self.ids[a + b]))
        self.prefixes = {t[:k] for t in self.ids for k in range(1, len(t))}
        # Tokens whose own encoding is one token; others never come out.
        self.sound: dict[int, bool] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self._anew()

    def _anew(self) -> None:
        # A state: (open suffix, last tokens at its boundaries, counts there relative to the end).
        self.states: list[tuple[bytes, tuple, tuple]] = [(b"", (-1,), (0,))]
        self.numbers = {self.states[0]: 0}
        self.used = 0
        self._room(1 << 16)

    def _room(self, slots: int) -> None:
        """An empty hash table of transitions: key ``state << 8 | byte``, value ``next state << 12 | change + 2048``."""
        self.keys, self.moves = np.full(slots, -1, np.int64), np.zeros(slots, np.int64)

    def encode(self, word: bytes) -> list[int]:
        """Plain merging, used to check pairs of tokens while compiling."""
        out = [self.ids[bytes([b])] for b in word]
        while len(out) > 1:
            best = min((self.merge.get(p, (1 << 30, -1)) for p in zip(out, out[1:])), default=(1 << 30, -1))
            if best[1] < 0:
                break
            at, new = 0, []
            while at < len(out):
                if at + 1 < len(out) and self.merge.get((out[at], out[at + 1])) == best:
                    new.append(best[1])
                    at += 2
                else:
                    new.append(out[at])
                    at += 1
            out = new
        return out

    def _is_sound(self, token: int) -> bool:
        if (known := self.sound.get(token)) is None:
            known = self.sound[token] = self.encode(self.bytes[token]) == [token]
        return known

    def _compatible(self, left: int, right: int) -> bool:
        """Whether the two tokens stay as they are when their texts are encoded together."""
        if left < 0:
            return True
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) > TRANSITIONS:
                self.pairs.clear()
            known = self.pairs[left, right] = self.encode(self.bytes[left] + self.bytes[right]) == [left, right]
        return known

    def _compile(self, state: int, byte: int) -> int:
        """The transition as ``next state << 12 | change of the count + 2048``."""
        suffix, lasts, counts = self.states[state]
        grown = suffix + bytes([byte])
        # Boundary j of ``lasts`` stands before suffix[j:]; the last one is the end.
        for j in range(len(grown)):
            token = self.ids.get(grown[j:])
            if token is not None and self._is_sound(token) and self._compatible(lasts[j], token):
                change = counts[j] + 1
                break
        else:
            raise ValueError("no token fits")  # single bytes are tokens
        keep = next((k for k in range(len(grown)) if grown[k:] in self.prefixes), len(grown))
        new = (grown[keep:], (*lasts, token)[keep:], tuple(c - change for c in (*counts, change)[keep:]))
        return self._number(new) << 12 | (change + 2048)

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slot of each key: its own, or the empty one where it belongs; and whether it is its own."""
        mask = len(self.keys) - 1
        slot = ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.int64) & mask
        held = self.keys[slot]
        own = held == keys
        todo = np.flatnonzero(~own & (held >= 0))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & mask
            held = self.keys[slot[todo]]
            own[todo] = held == keys[todo]
            todo = todo[(held >= 0) & (held != keys[todo])]
        return slot, own

    def _learn(self, keys: list[int], moves: list[int]) -> None:
        self.used += len(keys)
        if 3 * self.used > len(self.keys):
            full = self.keys >= 0
            keys, moves = [*self.keys[full].tolist(), *keys], [*self.moves[full].tolist(), *moves]
            self._room(len(self.keys) * 4)
        key, move = np.array(keys, np.int64), np.array(moves, np.int64)
        while len(key):
            slot, _ = self._find(key)
            _, first = np.unique(slot, return_index=True)  # one key a slot at a time
            self.keys[slot[first]], self.moves[slot[first]] = key[first], move[first]
            rest = np.ones(len(key), bool)
            rest[first] = False
            key, move = key[rest], move[rest]

    def _step(self, keys: np.ndarray) -> np.ndarray:
        slot, own = self._find(keys)
        if not own.all():
            new = np.unique(keys[~own]).tolist()
            self._learn(new, [self._compile(k >> 8, k & 255) for k in new])
            slot, _ = self._find(keys)
        return self.moves[slot]

    def run(self, data: np.ndarray, marks: np.ndarray, begin: np.ndarray, end: np.ndarray, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """States after the given ranges of bytes, all ranges stepping together, and the changes of the count."""
        order = np.argsort(begin - end, kind="stable")
        at, size = begin[order], (end - begin)[order]
        state, total = states[order].astype(np.int64), np.zeros(len(order), np.int64)
        live = np.searchsorted(-size, -np.arange(int(size.max(initial=0))), side="left")
        for k, m in enumerate(live.tolist()):
            place = at[:m] + k
            move = self._step(np.where(marks[place], 0, state[:m]) << 8 | data[place])
            state[:m] = move >> 12
            total[:m] += (move & 4095) - 2048
        out, count = np.empty_like(state), np.empty_like(total)
        out[order], count[order] = state, total
        return out, count

    def counts(self, texts: list[bytes], chunk: int = CHUNK) -> np.ndarray:
        """Tokens of each text."""
        parts, owner, extra = [], [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            at = 0
            for m in self.special.finditer(text) if self.special else ():
                parts.append(text[at : m.start()])
                owner.append(i)
                extra[i] += 1
                at = m.end()
            parts.append(text[at:] if at else text)
            owner.append(i)
        kept = [k for k, p in enumerate(parts) if p]
        if not kept:
            return extra
        parts, owner = [parts[k] for k in kept], np.array(owner, np.int64)[kept]
        data = np.frombuffer(b"".join(parts), np.uint8)
        edges = starts_of(np.fromiter(map(len, parts), np.int64, len(parts)))
        heads = np.zeros(len(data), bool)
        heads[edges[:-1]] = True
        marks = word_marks(data, heads)
        n = -(-np.diff(edges) // chunk)
        part = np.repeat(np.arange(len(parts)), n)
        begin = edges[part] + ranges(np.zeros(len(n), np.int64), n) * chunk
        end = np.minimum(begin + chunk, edges[part + 1])
        marked = np.flatnonzero(marks)
        total, at, carried = np.zeros(len(parts), np.int64), 0, None
        while at < len(begin):
            to = max(at + 1, int(np.searchsorted(end, begin[at] + TOGETHER, side="right")))
            if self.used > TRANSITIONS:
                self._anew()
            some = slice(at, to)
            first = np.zeros(part[to - 1] - part[at] + 1, np.int64)
            if carried:
                first[0] = self._number(carried)
            # The run-up begins at the last marked byte nearby, if there is one.
            near = marked[np.searchsorted(marked, begin[some], side="right") - 1]
            guess, _ = self.run(data, marks, np.clip(near, begin[some] - RUN_UP, begin[some]), begin[some], np.zeros(to - at, np.int64))
            sums, last = self._compose(data, marks, begin[some], end[some], part[some] - part[at], guess, first)
            total[part[at] : part[to - 1] + 1] += sums
            carried = self.states[last] if to < len(part) and part[to] == part[to - 1] else None
            at = to
        return extra + np.bincount(owner, weights=total, minlength=len(texts)).astype(np.int64)

    def _number(self, state: tuple) -> int:
        """A state's number; a new one, where the table does not know it."""
        number = self.numbers.setdefault(state, len(self.states))
        if number == len(self.states):
            self.states.append(state)
        return number

    def _compose(self, data, marks, begin, end, part, guess, entering) -> tuple[np.ndarray, int]:
        """Tokens of each part: the composition of its chunks' maps, applied to the state that enters it.

        The maps' entries are nodes (chunk, state before); a node points to the next chunk's entry for its state after.
        Also returns the state after the last part.
        """
        first = np.flatnonzero(np.diff(part, prepend=-1))
        closing = np.append(part[1:] != part[:-1], True)
        forgets = marks[begin]  # a marked byte forgets the state before it
        before, chunk = np.where(forgets, 0, guess), np.arange(len(begin))
        before[first] = entering = np.where(forgets[first], 0, entering)
        after, tokens = self.run(data, marks, begin, end, before)
        while True:
            # Entries by (chunk, state before), each once.
            order = np.lexsort((before, chunk))
            chunk, before, after, tokens = chunk[order], before[order], after[order], tokens[order]
            new = np.append(True, (chunk[1:] != chunk[:-1]) | (before[1:] != before[:-1]))
            chunk, before, after, tokens = chunk[new], before[new], after[new], tokens[new]
            key = chunk << 32 | before
            follow = np.minimum(chunk + 1, len(begin) - 1)
            wanted = follow << 32 | np.where(forgets[follow], 0, after)
            jump = np.minimum(np.searchsorted(key, wanted), len(key) - 1)
            jump[closing[chunk] | (key[jump] != wanted)] = -1
            reach, sums = np.arange(len(key)), tokens.copy()
            while (go := np.flatnonzero(jump >= 0)).size:
                to = jump[go]
                sums[go], reach[go], jump[go] = sums[go] + sums[to], reach[to], jump[to]
            start = np.searchsorted(key, first << 32 | entering)
            end_node = reach[start]
            open_ = ~closing[chunk[end_node]]
            if not open_.any():
                return sums[start], int(after[end_node[-1]])
            # The state that the scan arrives with, and for the rest of the part the states that it has seen.
            at, state = [chunk[end_node[open_]] + 1], [after[end_node[open_]]]
            for node in end_node[open_].tolist():
                p = part[chunk[node]]
                low, high = np.searchsorted(chunk, np.searchsorted(part, [p, p + 1]))
                seen = np.unique(after[low:high])[:AHEAD]
                rest = np.arange(chunk[node] + 1, np.searchsorted(part, p + 1))
                at.append(np.repeat(rest, len(seen)))
                state.append(np.tile(seen, len(rest)))
            at, state = np.concatenate(at), np.concatenate(state)
            state[forgets[at]] = 0
            todo = np.setdiff1d(at << 32 | state, key)
            at, state = todo >> 32, todo & 0xFFFFFFFF
            found, count = self.run(data, marks, begin[at], end[at], state)
            chunk, before, after, tokens = np.append(chunk, at), np.append(before, state), np.append(after, found), np.append(tokens, count)


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Transducer(path)


def count_tokens(docs: DataFrame, *, tokenizer_path: str, limit: int, chunk: int = CHUNK) -> DataFrame:
    """One row for each document: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    A null text is empty: no bytes, no tokens. Texts of any length go the same way. Repeated rows and equal ids all
    come out; other columns are not read. One pass without a shuffle.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        machine = transducer(tokenizer_path)
        for batch in pieces(batches, "text"):
            texts = byte_texts(batch, "text")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(machine.counts(texts, chunk))], ["doc_id", "n_bytes", "n_tokens"])

    counted = docs.select("doc_id", text_of().alias("text")).mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
