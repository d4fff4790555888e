"""Exact encoding of many texts with a lower-casing, white-space-dropping BPE tokenizer, one distinct word at a time.

White space always ends a token of such a tokenizer, so the ids of a text are those of its words in order. Words
repeat; each distinct word goes through the tokenizers library once, and a bounded table in the Python worker
remembers its ids.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import byte_alphabet, coded_words, ranges, segment_sums, starts_of

#: Words remembered at most (about 150 bytes each beside their own), and bytes of these words: past either, only those
#: of the texts at hand are kept.
KNOWN, KNOWN_BYTES = 300_000, 16 << 20
#: Words of letters that go through the library in one string.
JOINED = 256
#: A tail of these after a letter is a token group of its own.
TAIL = '!"#$%&()*+,-./:;=?@[\\]^_`{}~'


@lru_cache(maxsize=4)
def tokenizer(path: str):
    """The library's tokenizer without truncation or padding, on one thread (a task has one core)."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


#: The word pattern by which tails of punctuation are groups of their own.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def require(spec: dict) -> None:
    """Raise unless the tokenizer file is of the kind that ``WordEncoder`` cuts texts for."""
    steps = [n.get("type") for n in (spec["normalizer"] or {}).get("normalizers", [])]
    cuts = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
    model = spec["model"]
    fits = {
        "normalizer": steps == ["NFC", "Replace", "Lowercase"],
        "word pattern": [c.get("type") for c in cuts] == ["Split", "ByteLevel"] and cuts[0]["pattern"].get("Regex") == WORD_PATTERN and cuts[0].get("invert") and cuts[0].get("behavior") == "Removed" and not cuts[1]["add_prefix_space"] and not cuts[1]["use_regex"],
        "model": model["type"] == "BPE" and bool(model.get("end_of_word_suffix")) and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges")),
        "last bytes": all(b + (model.get("end_of_word_suffix") or "") in model["vocab"] for b in byte_alphabet()),
        "added tokens": all(t["content"].startswith("<|") and not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) for t in spec["added_tokens"]),
    }
    if wrong := [name for name, good in fits.items() if not good]:
        raise ValueError(f"the tokenizer is of another kind: {', '.join(wrong)}")


class WordEncoder:
    """Ids of texts by distinct words. Valid only where white space separates tokens and is dropped."""

    def __init__(self, path: str):
        self.tokenizer = tokenizer(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        require(spec)
        suffix, vocab = spec["model"]["end_of_word_suffix"], self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        self._forget()

    def _forget(self) -> None:
        """Known words: each one's number, and by number the place of its ids in the flat list. The empty word has none."""
        self.known: dict[bytes, int] = {b"": 0}
        self.bytes = 0
        self.flat, self.used = np.empty(1 << 12, np.uint32), 0
        self.starts, self.lens = np.zeros(1 << 10, np.int64), np.zeros(1 << 10, np.int64)

    def _by_library(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words by the library, and the number of ids of each; words of letters go many at a time.

        The library cuts every word into one token group or more, and the last id of a group alone has the end-of-word
        suffix. So where a string of n words has n such ids, each word is one group and these ids end the words;
        where it has more (a letter whose lower case holds a mark), its words go one at a time.
        """
        letters = np.fromiter(map(str.isalpha, words), bool, len(words))
        plain, queue = np.flatnonzero(letters), [np.flatnonzero(~letters)]
        blocks = [plain[i : i + JOINED] for i in range(0, len(plain), JOINED)]
        order, ids, lens = [], [], []
        for at, e in zip(blocks, self._each([" ".join([words[i] for i in at]) for at in blocks]), strict=True):
            found = np.array(e.ids, np.uint32)
            last = np.flatnonzero(self.ends[found])
            if len(last) == len(at):
                order.append(at)
                ids.append(found)
                lens.append(np.diff(last, prepend=-1))
            else:
                queue.append(at)
        alone = np.concatenate(queue)
        each = [e.ids for e in self._each([words[i] for i in alone])]
        order.append(alone)
        ids.append(np.array([i for x in each for i in x], np.uint32))
        lens.append(np.fromiter(map(len, each), np.int64, len(each)))
        flat, size, back = np.concatenate(ids), np.concatenate(lens), np.argsort(np.concatenate(order))
        starts = np.cumsum(size) - size
        return flat[ranges(starts[back], size[back])], size[back]

    def _each(self, texts: list[str]) -> list:
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)

    def _learn(self, words: list[bytes]) -> None:
        """Encode new words by the library."""
        self._add(words, *self._by_library([w.decode() for w in words]))

    def _keep(self, words: list[bytes]) -> None:
        """Forget all words but these."""
        old = [w for w in words if w and w in self.known]
        place = np.fromiter(map(self.known.__getitem__, old), np.int64, len(old))
        lens = self.lens[place]
        ids = self.flat[ranges(self.starts[place], lens)]
        self._forget()
        self._add(old, ids, lens)

    def _add(self, words: list[bytes], ids: np.ndarray, lens: np.ndarray) -> None:
        n, m = len(self.known), len(words)
        while len(self.flat) < self.used + len(ids):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        while len(self.starts) < n + m:
            self.starts, self.lens = np.concatenate([self.starts, np.zeros_like(self.starts)]), np.concatenate([self.lens, np.zeros_like(self.lens)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.starts[n : n + m] = self.used + np.cumsum(lens) - lens
        self.lens[n : n + m] = lens
        self.used += len(ids)
        self.bytes += sum(map(len, words))
        self.known.update(zip(words, range(n, n + m), strict=True))

    def _table(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct words: a flat list, and the start and number of each word's ids in it."""
        names = words.to_pylist()
        if len(self.known) > KNOWN or self.bytes > KNOWN_BYTES:
            self._keep(names)
        if new := [w for w in names if w not in self.known]:
            self._learn(new)
        place = np.fromiter(map(self.known.__getitem__, names), np.int64, len(names))
        return self.flat, self.starts[place], self.lens[place]

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and the number of ids of each text."""
        codes, distinct, counts = coded_words(texts)
        core, tail = lower_and_tail(distinct)
        coded = pa.chunked_array([core, tail]).combine_chunks().dictionary_encode()
        flat, starts, lens = self._table(coded.dictionary)
        pair = coded.indices.to_numpy().reshape(2, -1).T
        both = pair[codes].reshape(-1)
        sizes = lens[both]
        return flat[ranges(starts[both], sizes)], segment_sums(segment_sums(sizes, np.full(len(codes), 2)), counts)


def buffers(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Start of each value of a large binary array, and the bytes."""
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words)] if len(words) else np.empty(0, np.int64)
    return offsets, np.frombuffer(words.buffers()[2] or b"", np.uint8)


def lower_and_tail(words: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Words in lower case without their tail of punctuation, and that tail, where the two are encoded apart.

    The tail follows an ASCII letter; else it stays in the word. Words that may hold a special token stay as they are.
    """
    special = pc.or_(pc.match_substring(words, "<|"), pc.match_substring(words, "|>"))
    low = pc.if_else(special, words, pc.ascii_lower(words))
    core = pc.ascii_rtrim(low, characters=TAIL)
    sizes, cut = (pc.binary_length(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in (low, core))
    low = low.cast(pa.large_binary())
    begin, data = buffers(low)
    last = data[begin + np.maximum(cut, 1) - 1] if len(low) else np.empty(0, np.uint8)
    apart = (cut > 0) & (cut < sizes) & (last >= 97) & (last <= 122) & ~special.to_numpy(zero_copy_only=False)
    cut = np.where(apart, cut, sizes)

    def parts(at: np.ndarray, n: np.ndarray) -> pa.Array:
        offsets = starts_of(n)
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(offsets), pa.py_buffer(data[ranges(at, n)])])

    return parts(begin, cut), parts(begin + cut, sizes - cut)


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)
