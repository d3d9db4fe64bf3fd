"""Byte-level BPE ids of whole texts, fast: equal pre-tokens of a task are encoded once."""

from __future__ import annotations

import ctypes
import re
import sys
from types import ModuleType

import numpy as np
import pyarrow as pa

from strata.llm.spans import SpanHasher, ragged

#: Characters of texts whose pre-tokens are runs of one byte class, each with one space before it at
#: most: no apostrophe (contractions), and no two blanks together or at an end.
_RUNS = re.compile(r"[\n -&(-~À-ÖØ-öø-ſ]+")
_BLANKS = ("  ", "\n\n", " \n", "\n ")
_LETTER, _DIGIT, _OTHER, _SPACE, _FEED = range(5)
#: Distinct pre-tokens that one worker keeps (about 30 bytes each), in two halves: a full half replaces the one
#: before it, whose pre-tokens stay if they were met again since (bounds memory, not results).
CACHE_WORDS = 1_000_000


def _byte_classes() -> np.ndarray:
    kinds = np.full(256, _OTHER, np.uint8)
    kinds[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz") + list(range(128, 256))] = _LETTER
    kinds[list(b"0123456789")] = _DIGIT
    kinds[ord(" ")], kinds[ord("\n")] = _SPACE, _FEED
    return kinds


def _byte_letters() -> dict[int, str]:
    """Fixed rule of byte-level vocabularies: printable bytes stand for themselves, the others for U+0100 on, in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


def _is_runs(text: str) -> bool:
    return bool(_RUNS.fullmatch(text)) and not any(b in text for b in _BLANKS) and not text[0].isspace() and not text[-1].isspace()


class _Learnt:
    """Ids of pre-tokens by their hashes, which are ascending."""

    def __init__(self, hashes: np.ndarray, ids: np.ndarray, counts: np.ndarray):
        self.hashes, self.ids, self.counts = hashes, ids, counts
        self.starts = np.cumsum(counts) - counts

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each hash is or would be, and whether it is there."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return at, self.hashes[at] == hashes

    def add(self, hashes: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """Adds ascending hashes that aren't there yet."""
        at, starts = np.searchsorted(self.hashes, hashes), len(self.ids) + np.cumsum(counts) - counts
        self.hashes, self.starts, self.counts = (np.insert(old, at, new) for old, new in ((self.hashes, hashes), (self.starts, starts), (self.counts, counts)))
        self.ids = np.concatenate([self.ids, ids])


class CachedEncoder:
    """Encodes texts with a byte-level BPE file of the ``tokenizers`` library, special strings as ordinary text.

    Merges never cross pre-tokens, so a text's ids are those of its pre-tokens
    in order. In most texts these are runs of bytes of one class; they are
    found and compared as numbers, and the library encodes those not seen
    before, all at once. Any other text goes to the tokenizer whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        self._split, self._lines = self._tokenizer.pre_tokenizer, CharDelimiterSplit("\n")
        self._letters = _byte_letters()
        self._feed = self.whole("\n")
        self._letters[10] = "\n"
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=False)
        self._length = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self._length[list(vocabulary.values())] = [len(t) for t in vocabulary]
        self._classes, self._hasher = _byte_classes(), SpanHasher()
        self._known, self._older = self._only_feed(), self._only_feed()

    def _only_feed(self) -> _Learnt:
        one = self._hasher.hashes(np.frombuffer(b"\n", np.uint8), np.array([0]), np.array([1]))
        return _Learnt(one, np.frombuffer(self._feed, "<u4"), np.array([len(self._feed) // 4]))

    def whole(self, text: str) -> bytes:
        self._tokenizer.pre_tokenizer = self._split
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, one after another, and each one's number of ids."""
        joined = b"\n".join(words).decode("latin-1").translate(self._letters)
        self._tokenizer.pre_tokenizer = self._lines
        ids = np.array(self._tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
        ends = np.searchsorted(np.cumsum(self._length[ids]), np.cumsum(list(map(len, words)))) + 1
        return ids, np.diff(ends, prepend=0)

    def _encode_runs(self, texts: list[bytes]) -> list[bytes]:
        joined = b"\n".join([*texts, b""])
        data = np.frombuffer(joined, np.uint8)
        kinds = self._classes[data]
        begins = np.ones(len(data), bool)
        begins[1:] = (kinds[1:] != kinds[:-1]) & (kinds[:-1] != _SPACE)
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(data))
        hashes, first, which = np.unique(self._hasher.hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self._known.hashes) > CACHE_WORDS // 2:
            self._known, self._older = self._only_feed(), self._known
        new = np.flatnonzero(~self._known.find(hashes)[1])
        at, there = self._older.find(hashes[new])
        if there.any():
            again, at = new[there], at[there]
            counts = self._older.counts[at]
            self._known.add(hashes[again], self._older.ids[ragged(self._older.starts[at], counts)], counts)
            new = new[~there]
        if len(new):
            words = [joined[a:b] for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist())]
            self._known.add(hashes[new], *self._learn(words))
        at, _ = self._known.find(hashes)
        each = self._known.counts[at][which]
        closing = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts]) - 1)  # the line feeds put after the texts
        each[closing] = 0
        out = self._known.ids[ragged(self._known.starts[at][which], each)].tobytes()
        cuts = [0, *(4 * np.cumsum(each)[closing]).tolist()]
        return [out[a:b] for a, b in zip(cuts, cuts[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        runs = [k for k, t in enumerate(texts) if _is_runs(t)]
        out = dict(zip(runs, self._encode_runs([texts[k].encode() for k in runs]))) if runs else {}
        return [out[k] if k in out else self.whole(t) for k, t in enumerate(texts)]


def worker_kept(key, make):
    """What ``make`` gives, made once for all tasks in a row that this Python worker runs with ``key``.

    Functions are shipped by value, so their globals aren't kept. There is one
    slot: work of another kind frees what the work before has kept.
    """
    slot = sys.modules.setdefault("_strata_worker", ModuleType("_strata_worker")).__dict__
    if slot.get("key") != key:
        slot["key"] = slot["value"] = None
        slot["value"] = make()
        slot["key"] = key
    return slot["value"]


def worker_encoder(path: str) -> CachedEncoder:
    return worker_kept(("encoder", path), lambda: CachedEncoder(path))


def tidied(step):
    """``step`` (from batches to frames) that gives back to the machine what it has freed, when its task ends: idle workers stay beside the stages that follow."""

    def run(batches):
        yield from step(batches)
        pa.default_memory_pool().release_unused()
        if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
            libc.malloc_trim(0)

    return run


def groups_of(texts, max_chars: int = 1_000_000):
    """Index ranges of consecutive texts of about ``max_chars`` together: bounds a task's memory."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= max_chars:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
