"""Sampled SentencePiece segmentations by forward filtering and backward sampling; lossless decoding.

A text is a lattice: nodes between its characters, and an edge for every piece
of the vocabulary that spells what lies between two nodes. A segmentation is a
path, its probability proportional to the product of its pieces' weights. The
forward filter sums the weights of all paths to each node; from the end, each
edge is drawn with its exact conditional probability. Draws come from a hash
of the row's key, the place in the text and the step, so a row gets the same
segmentation in any partition and any run.

No piece crosses from other characters to a space or over a line feed, so the
lattice falls apart into chunks (spaces and the characters up to the next
ones). Equal chunks share one filter; each occurrence is drawn on its own.
Characters without a piece are spelt by the byte pieces.

A piece's weight follows its rank in the vocabulary (its score is minus that
rank): 1 / (rank + 2.7) to the power ``sharpness``. A text gets one space in
front, as the vocabulary's own encoder does, and decoding removes it.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from strata.llm.common import plain_key, restore_key
from strata.llm.spans import SpanHasher, mixed, ragged
from strata.llm.tokens import groups_of, worker_kept


#: Characters of a lattice: chunks that repeat within it are filtered once, and it bounds a task's memory.
GROUP_CHARS = 4_000_000


class PieceSampler:
    """Encoder and decoder of one vocabulary file (a ``sentencepiece`` model with byte pieces)."""

    def __init__(self, path: str, sharpness: float = 1.0):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        spelt = [b""] * n
        self._byte_id = np.full(256, -1, np.int64)
        piece_ids = []
        for k in range(n):
            name = model.id_to_piece(k)
            if model.is_byte(k):
                spelt[k] = bytes([int(name[3:5], 16)])
                self._byte_id[spelt[k][0]] = k
            elif not (model.is_control(k) or model.is_unknown(k) or model.is_unused(k)):
                spelt[k] = name.replace("▁", " ").encode()
                if b" " not in spelt[k].lstrip(b" ") and b"\n" not in spelt[k]:  # what the chunks rely on
                    piece_ids.append(k)
        if (self._byte_id < 0).any():
            raise ValueError("the vocabulary must have all byte pieces: without them decoding isn't lossless")
        self._flat = np.frombuffer(b"".join(spelt), np.uint8)
        self._size = np.array(list(map(len, spelt)), np.int64)
        self._at = np.cumsum(self._size) - self._size
        ids = np.array(piece_ids, np.int64)
        self._hasher = SpanHasher()
        hashes = self._hasher.hashes(self._flat, self._at[ids], self._at[ids] + self._size[ids])
        order = np.argsort(hashes)
        self._hash, self._piece = hashes[order], ids[order]
        self._maybe = np.zeros(1 << 21, bool)  # most spans aren't pieces: this tells quickly
        self._maybe[self._hash & np.uint64(len(self._maybe) - 1)] = True
        rank = np.array([-model.get_score(int(k)) for k in self._piece])
        self._weight = -sharpness * np.log(np.maximum(rank, 0) + 2.7)
        self._byte_weight = -sharpness * np.log(n + 2.7)
        self._longest = max(len(spelt[k].decode()) for k in piece_ids)

    def _lattice(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> dict:
        """Filter of the chunks [start, end): edges by end node, with cumulative probabilities."""
        sizes = ends - starts
        own = ragged(starts, sizes)
        chunk = np.repeat(np.arange(len(starts)), sizes)
        head = (data[own] & 0xC0) != 0x80  # first byte of a character
        char_at, char_chunk = own[head], chunk[head]
        char_end = np.append(char_at[1:], 0)
        last = np.append(char_chunk[1:] != char_chunk[:-1], True)
        char_end[last] = ends[char_chunk[last]]
        n_chars = np.bincount(char_chunk, minlength=len(starts))
        first_char = np.cumsum(n_chars) - n_chars
        place = np.arange(len(char_at)) - first_char[char_chunk]
        node = np.arange(len(char_at)) + char_chunk  # the node before each character; a chunk has one more
        src, dst, piece, weight = [], [], [], []
        single = np.zeros(len(char_at), bool)
        for length in range(1, self._longest + 1):
            k = np.flatnonzero(place + length <= n_chars[char_chunk])
            if not len(k):
                break
            hashes = self._hasher.spans(char_at[k], char_end[k + length - 1])
            some = self._maybe[hashes & np.uint64(len(self._maybe) - 1)]
            k, hashes = k[some], hashes[some]
            where = np.minimum(np.searchsorted(self._hash, hashes), len(self._hash) - 1)
            found = self._hash[where] == hashes
            k, where = k[found], where[found]
            if length == 1:
                single[k] = True
            src.append(node[k])
            dst.append(node[k] + length)
            piece.append(self._piece[where])
            weight.append(self._weight[where])
        k = np.flatnonzero(~single)  # spelt by bytes; the piece is minus one minus the character's place
        src.append(node[k])
        dst.append(node[k] + 1)
        piece.append(-1 - char_at[k])
        weight.append(self._byte_weight * (char_end[k] - char_at[k]))
        src, dst, piece, weight = (np.concatenate(x) for x in (src, dst, piece, weight))
        begin = first_char + np.arange(len(starts))  # first node of each chunk
        node_chunk = np.repeat(np.arange(len(starts)), n_chars + 1)
        order = np.argsort(dst, kind="stable")
        src, dst, piece, weight = src[order], dst[order], piece[order], weight[order]
        total = np.zeros(len(node_chunk))
        by_place = np.argsort(dst - begin[node_chunk[dst]], kind="stable")
        steps = np.bincount((dst - begin[node_chunk[dst]]), minlength=1)
        at = int(steps[0])
        for n in steps[1:].tolist():  # forward filter: all nodes at one place of their chunks at a time
            e = by_place[at : at + n]
            at += n
            value = total[src[e]] + weight[e]
            new = np.flatnonzero(np.append(True, dst[e][1:] != dst[e][:-1]))
            top = np.maximum.reduceat(value, new)
            counts = np.diff(np.append(new, n))
            total[dst[e[new]]] = top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, counts)), new))
        share = np.exp(total[src] + weight - total[dst])
        new = np.append(True, dst[1:] != dst[:-1])
        nth = np.arange(len(dst)) - np.repeat(np.flatnonzero(new), np.diff(np.append(np.flatnonzero(new), len(dst))))
        run, by_nth = share.copy(), np.argsort(nth, kind="stable")
        at = int((nth == 0).sum())
        for n in np.bincount(nth)[1:].tolist():  # every node by itself, so sums don't depend on what else is in the batch
            e = by_nth[at : at + n]
            at += n
            run[e] += run[e - 1]
        width = np.where(piece >= 0, 1, 0)
        k = np.flatnonzero(piece < 0)
        width[k] = char_end[np.searchsorted(char_at, -1 - piece[k])] - (-1 - piece[k])
        edge_end = np.cumsum(np.bincount(dst, minlength=len(node_chunk))) - 1
        return {"src": src, "piece": piece, "width": width, "cumulative": (dst.astype(np.uint64) << np.uint64(32)) + np.minimum(run * (1 << 32), (1 << 32) - 1).astype(np.uint64), "last": edge_end, "begin": begin, "end": begin + n_chars}

    def encode(self, texts: list[str], seeds: np.ndarray) -> list[np.ndarray]:
        """Sampled ids of each text; ``seeds``: a 64-bit integer for each."""
        raws = [b" " + t.encode() for t in texts]
        joined = b"".join(raws)
        data = np.frombuffer(joined, np.uint8)
        space, feed = data == 32, data == 10
        opens = np.append(True, (space[1:] & ~space[:-1]) | feed[1:] | feed[:-1])
        edges = np.cumsum([0, *map(len, raws)])
        opens[edges[:-1]] = True
        starts = np.flatnonzero(opens)
        ends = np.append(starts[1:], len(data))
        text = np.searchsorted(edges, starts, side="right") - 1
        _, first, which = np.unique(self._hasher.hashes(data, starts, ends), return_index=True, return_inverse=True)
        lattice = self._lattice(data, np.sort(starts[first]), ends[np.sort(first)])
        rank = np.empty(len(first), np.int64)
        rank[np.argsort(first)] = np.arange(len(first))
        which = rank[which]
        key = mixed(seeds[text] + (np.arange(len(starts)) - np.searchsorted(text, text)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        node, alive, draws = lattice["end"][which], np.argsort(which, kind="stable"), []  # like chunks together: near in memory
        step = 0
        while len(alive):  # backward sampling: one edge of every unfinished occurrence at a time
            step += 1
            u = mixed(key[alive] + np.uint64(step)) >> np.uint64(32)
            at = node[alive]
            edge = np.minimum(np.searchsorted(lattice["cumulative"], (at.astype(np.uint64) << np.uint64(32)) + u, side="right"), lattice["last"][at])
            draws.append((alive, edge))
            node[alive] = lattice["src"][edge]
            alive = alive[node[alive] > lattice["begin"][which[alive]]]
        widths = np.zeros(len(starts), np.int64)
        for some, edge in draws:
            widths[some] += lattice["width"][edge]
        cursor = np.cumsum(widths)
        cuts = cursor[np.searchsorted(text, np.arange(len(texts)), side="right") - 1]
        out = np.empty(int(cursor[-1]), np.uint32)
        for some, edge in draws:
            cursor[some] -= lattice["width"][edge]
            piece = lattice["piece"][edge]
            whole = piece >= 0
            out[cursor[some[whole]]] = piece[whole]
            if not whole.all():
                spelt, size = edge[~whole], lattice["width"][edge[~whole]]
                out[ragged(cursor[some[~whole]], size)] = self._byte_id[data[ragged(-1 - lattice["piece"][spelt], size)]]
        return np.split(out, cuts[:-1])

    def decode(self, ids: np.ndarray) -> str:
        """The text that was encoded."""
        return self._flat[ragged(self._at[ids], self._size[ids])].tobytes()[1:].decode()


def row_seeds(keys: pd.Series, none: pd.Series, seed: int) -> np.ndarray:
    """A 64-bit seed for each key; those where ``none`` holds share one."""
    return mixed(mixed(keys.to_numpy(np.int64).view(np.uint64)) + np.uint64(seed) + none.to_numpy(np.uint64) * np.uint64(0xA5A5A5A5))


def sample_pieces(docs: DataFrame, vocabulary: str, seed: int = 0, sharpness: float = 1.0) -> DataFrame:
    """doc_id, ids (binary u32) and the text decoded from them, for every whole ``text``.

    A null text counts as empty; an empty one is the space put in front. Rows
    that repeat a key draw from the same numbers, so equal texts get equal
    ids; null keys share one seed; other columns are ignored.
    """

    def encode(batches):
        sampler = worker_kept(("pieces", vocabulary, sharpness), lambda: PieceSampler(vocabulary, sharpness))
        for batch in batches:
            texts, seeds = batch["text"].fillna("").tolist(), row_seeds(batch["doc_id"], batch["no_key"], seed)
            for a, b in groups_of(texts, GROUP_CHARS):
                ids = sampler.encode(texts[a:b], seeds[a:b])
                yield pd.DataFrame({
                    "doc_id": batch["doc_id"].iloc[a:b], "no_key": batch["no_key"].iloc[a:b],
                    "ids": [x.astype("<u4").tobytes() for x in ids], "decoded": [sampler.decode(x) for x in ids],
                })

    rows = plain_key(docs, "doc_id", F.col("text").cast("string").alias("text"))
    return restore_key(rows.mapInPandas(encode, "doc_id long, no_key boolean, ids binary, decoded string"), "doc_id")


def sample_digest(docs: DataFrame, vocabulary: str, seed: int = 0, sharpness: float = 1.0) -> DataFrame:
    """doc_id, n_pieces, ids_crc32 and whether the ids decode to the text, for every whole ``text``; as `sample_pieces`."""

    def encode(batches):
        sampler = worker_kept(("pieces", vocabulary, sharpness), lambda: PieceSampler(vocabulary, sharpness))
        for batch in batches:
            texts, seeds = batch["text"].fillna("").tolist(), row_seeds(batch["doc_id"], batch["no_key"], seed)
            for a, b in groups_of(texts, GROUP_CHARS):
                ids = sampler.encode(texts[a:b], seeds[a:b])
                yield pd.DataFrame({
                    "doc_id": batch["doc_id"].iloc[a:b], "no_key": batch["no_key"].iloc[a:b], "n_pieces": [len(x) for x in ids],
                    "ids_crc32": [zlib.crc32(x.astype("<u4").tobytes()) for x in ids],
                    "lossless": [sampler.decode(x) == t for x, t in zip(ids, texts[a:b])],
                })

    rows = plain_key(docs, "doc_id", F.col("text").cast("string").alias("text"))
    return restore_key(rows.mapInPandas(encode, "doc_id long, no_key boolean, n_pieces long, ids_crc32 long, lossless boolean"), "doc_id")
