"""Token-ID files in patched frame-of-reference (PFOR) blocks.

A file is a Parquet folder whose rows are segments; a segment's ``payload`` is
the binary format below, so any store that Spark reads holds the files and
Spark's commit protocol protects them from lost executors. Parts are in
ascending ``doc_id`` order, and segments and documents in order inside a part.
Each row also has its least and largest key, so a reader of a few documents, or of
a range of ids, reads the payloads of segments that may hold them only, and of
these unpacks the blocks that the index names.

Payload (little-endian): ``PFR1``, documents u32, blocks u32, ids u64; then per
document its key (i64), whether the key is null (u8), and its id count (u32);
then the block index: byte start (u32), minimum (u32), width (u8) and
exceptions (u8) of each block; then the blocks. A block holds 128 ids minus
their minimum (the last block fewer, padded), packed in ``width`` bits, then
the positions (u8) and the high parts (u32) of its exceptions: the ids that
don't fit. ``width`` is what the given share of the block's ids needs.
"""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from strata.llm.common import plain_key, shuffle_width, small_batches
from strata.llm.tokens import groups_of, tidied, worker_encoder

BLOCK = 128
#: Share of a block's ids that its width must hold without an exception.
PACKED_SHARE = 0.9
#: Ids after which a segment is closed; a document is never cut, so a longer one is a segment of its own.
SEGMENT_IDS = 1 << 18
_MAGIC = b"PFR1"
_HEAD = "<4sIIQ"

#: Code points of a text that order the rows of one key.
ORDERED_CHARS = 256
#: Keys of a read by key that are told to the files' filter; more are read in rounds of as many.
KEYS_AT_ONCE = 500

SEGMENT_SCHEMA = "part int, segment int, first_id long, n_ids long, low_key long, high_key long, null_keys boolean, payload binary"
DOCUMENT_SCHEMA = "part int, doc_id long, start long, n_tokens long, ids binary"


def pack_ids(ids: np.ndarray, share: float = PACKED_SHARE) -> tuple[bytes, bytes]:
    """Block index and blocks of unsigned 32-bit ``ids``."""
    n_blocks = -(-len(ids) // BLOCK)
    if not n_blocks:
        return b"", b""
    grid = np.full(n_blocks * BLOCK, ids[-1], np.uint32)
    grid[: len(ids)] = ids
    grid = grid.reshape(n_blocks, BLOCK)
    low = grid.min(axis=1)
    rest = grid - low[:, None]
    need = np.frexp(rest.astype(np.float64))[1].astype(np.uint8)
    rank = min(BLOCK - 1, int(np.ceil(share * BLOCK)) - 1)
    width = np.partition(need, rank, axis=1)[:, rank]
    odd = need > width[:, None]
    n_odd = odd.sum(axis=1)
    sizes = width.astype(np.int64) * (BLOCK // 8) + 5 * n_odd
    starts = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), np.uint8)
    for w in np.unique(width[width > 0]).tolist():
        rows = np.flatnonzero(width == w)
        kind = "<u2" if w <= 16 else "<u4"
        values = (rest[rows] & np.uint32((1 << w) - 1)).astype(kind)
        bits = np.unpackbits(values.view(np.uint8).reshape(len(rows), BLOCK, -1), axis=2, bitorder="little")[:, :, :w]
        packed = np.packbits(bits.reshape(len(rows), -1), axis=1, bitorder="little")
        out[starts[rows, None] + np.arange(packed.shape[1])] = packed
    block, place = np.nonzero(odd)
    if len(block):
        after = starts + width.astype(np.int64) * (BLOCK // 8)
        nth = np.arange(len(block)) - (np.cumsum(n_odd) - n_odd)[block]
        out[after[block] + nth] = place
        high = np.ascontiguousarray((rest[block, place] >> width[block].astype(np.uint32)).astype("<u4")).view(np.uint8).reshape(-1, 4)
        out[(after[block] + n_odd[block] + 4 * nth)[:, None] + np.arange(4)] = high
    index = np.zeros(n_blocks, _INDEX)
    index["start"], index["low"], index["width"], index["odd"] = starts, low, width, n_odd
    return index.tobytes(), out.tobytes()


_INDEX = np.dtype([("start", "<u4"), ("low", "<u4"), ("width", "u1"), ("odd", "u1")])


def unpack_ids(index: bytes, blocks: bytes, n_ids: int, first_block: int = 0, n_blocks: int | None = None) -> np.ndarray:
    """The ids of ``n_blocks`` blocks from ``first_block`` on (all by default), found by the block index."""
    table, data = np.frombuffer(index, _INDEX), np.frombuffer(blocks, np.uint8)
    stop = len(table) if n_blocks is None else min(len(table), first_block + n_blocks)
    table = table[first_block:stop]
    grid = np.zeros((len(table), BLOCK), np.uint32)
    width, starts = table["width"].astype(np.int64), table["start"].astype(np.int64)
    for w in np.unique(width[width > 0]).tolist():
        rows = np.flatnonzero(width == w)
        packed = data[starts[rows, None] + np.arange(w * BLOCK // 8)]
        bits = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(rows), BLOCK, w)
        size = 16 if w <= 16 else 32
        full = np.zeros((len(rows), BLOCK, size), np.uint8)
        full[:, :, :w] = bits
        grid[rows] = np.packbits(full, axis=2, bitorder="little").view(f"<u{size // 8}").reshape(len(rows), BLOCK)
    n_odd = table["odd"].astype(np.int64)
    block = np.repeat(np.arange(len(table)), n_odd)
    if len(block):
        nth = np.arange(len(block)) - (np.cumsum(n_odd) - n_odd)[block]
        after = (starts + width * (BLOCK // 8))[block]
        high = np.ascontiguousarray(data[(after + n_odd[block] + 4 * nth)[:, None] + np.arange(4)]).view("<u4")[:, 0]
        grid[block, data[after + nth]] |= high << width[block].astype(np.uint32)
    grid += table["low"][:, None]
    return grid.reshape(-1)[: min(n_ids, stop * BLOCK) - first_block * BLOCK]


def pack_segment(keys: list[int | None], ids: list[bytes]) -> bytes:
    """The payload of consecutive documents; ``ids``: each one's as little-endian unsigned 32-bit integers."""
    flat = np.frombuffer(b"".join(ids), "<u4")
    index, blocks = pack_ids(flat)
    return b"".join([
        struct.pack(_HEAD, _MAGIC, len(keys), len(index) // _INDEX.itemsize, len(flat)),
        np.array([0 if k is None else k for k in keys], "<i8").tobytes(),
        np.array([k is None for k in keys], np.uint8).tobytes(),
        np.array([len(x) // 4 for x in ids], "<u4").tobytes(),
        index, blocks,
    ])


class Segment:
    """A payload's keys, places of documents and block index; ids are unpacked on demand."""

    def __init__(self, payload: bytes):
        magic, n_docs, n_blocks, self.n_ids = struct.unpack_from(_HEAD, payload)
        if magic != _MAGIC:
            raise ValueError("not a token segment")
        at = struct.calcsize(_HEAD)
        self.keys = np.frombuffer(payload, "<i8", n_docs, at)
        self.null = np.frombuffer(payload, np.uint8, n_docs, at + 8 * n_docs) > 0
        self.counts = np.frombuffer(payload, "<u4", n_docs, at + 9 * n_docs).astype(np.int64)
        self.starts = np.cumsum(self.counts) - self.counts
        at += 13 * n_docs
        self._index, self._blocks = payload[at : at + n_blocks * _INDEX.itemsize], payload[at + n_blocks * _INDEX.itemsize :]

    def ids(self, start: int = 0, stop: int | None = None) -> tuple[np.ndarray, int]:
        """The ids from ``start`` to ``stop`` (exclusive) of the segment, and how many blocks were unpacked for them."""
        stop = self.n_ids if stop is None else min(stop, self.n_ids)
        if start >= stop:
            return np.zeros(0, np.uint32), 0
        first, last = start // BLOCK, (stop - 1) // BLOCK
        found = unpack_ids(self._index, self._blocks, self.n_ids, first, last - first + 1)
        return found[start - first * BLOCK : stop - first * BLOCK], last - first + 1


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0) -> None:
    """Write the ids of every whole ``text`` and ``end_id`` after each, in ascending ``doc_id`` order.

    ``docs``: doc_id and text; further columns are ignored. A null text counts
    as empty (one id, the end). Null keys come first; rows that repeat a key
    are all kept, in the order of their texts' first ``ORDERED_CHARS`` code
    points. One range shuffle of the texts, whose bounds also tell texts and
    rows of one key apart, so such rows spread over tasks; a task keeps one
    segment at a time.
    """
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches):
        encoder, part = worker_encoder(tokenizer), TaskContext.get().partitionId()
        keys, ids, size, segment, first = [], [], 0, 0, 0
        for batch in batches:
            texts = batch["text"].fillna("").tolist()
            all_keys = [None if none else k for k, none in zip(batch["doc_id"].tolist(), batch["no_key"])]
            for a, b in groups_of(texts):
                for key, raw in zip(all_keys[a:b], encoder.encode(texts[a:b])):
                    keys.append(key)
                    ids.append(raw + end)
                    size += len(raw) // 4 + 1
                    if size >= SEGMENT_IDS:
                        yield closed(part, segment, first, size, keys, ids)
                        first += size
                        keys, ids, size, segment = [], [], 0, segment + 1
        if keys:
            yield closed(part, segment, first, size, keys, ids)

    def closed(part, segment, first, size, keys, ids):
        known = [k for k in keys if k is not None]
        low, high = pd.array([min(known)] if known else [None], "Int64"), pd.array([max(known)] if known else [None], "Int64")
        return pd.DataFrame({"part": [part], "segment": [segment], "first_id": [first], "n_ids": [size], "low_key": low, "high_key": high, "null_keys": [len(known) < len(keys)], "payload": [pack_segment(keys, ids)]})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = ["doc_id", "head", "h", "u"]
    rows = rows.withColumns({"head": F.substring("text", 1, ORDERED_CHARS), "h": F.xxhash64("text"), "u": F.monotonically_increasing_id()})
    rows = rows.repartitionByRange(shuffle_width(docs.sparkSession), *order).sortWithinPartitions(*order)
    with small_batches(docs.sparkSession):
        plain_key(rows, "doc_id", "text").mapInPandas(tidied(encode), SEGMENT_SCHEMA).write.option("compression", "none").parquet(path)


def _segments(spark: SparkSession, path: str) -> DataFrame:
    """The files' rows with ``base``, the ids of all parts before."""
    files = spark.read.schema(SEGMENT_SCHEMA).parquet(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over one row a part
    bases = files.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return files.join(F.broadcast(bases), "part")  # two numbers a part, of which there are as many as tasks wrote


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Each document of the files: doc_id, start (ids before it in all files), n_tokens, ids (binary u32)."""

    def decode(batches):
        for batch in batches:
            for part, base, first, payload in zip(batch["part"], batch["base"], batch["first_id"], batch["payload"]):
                segment = Segment(payload)
                raw, ends = segment.ids()[0].astype("<u4").tobytes(), (segment.starts + segment.counts).tolist()
                keys = pd.arrays.IntegerArray(segment.keys.copy(), segment.null.copy())
                yield pd.DataFrame({
                    "part": np.int32(part), "doc_id": keys, "start": base + first + segment.starts, "n_tokens": segment.counts,
                    "ids": [raw[4 * a : 4 * b] for a, b in zip(segment.starts.tolist(), ends)],
                })

    return _segments(spark, path).select("part", "base", "first_id", "payload").mapInPandas(decode, DOCUMENT_SCHEMA).drop("part")


def read_documents(spark: SparkSession, path: str, keys: list[int | None]) -> DataFrame:
    """The documents with the given keys (None: null ones), as `read_token_files` gives them, and ``blocks``, how many were unpacked for each.

    Segments without such keys are left out by the files' statistics and
    never read; of the others only the blocks that hold a wanted document are
    unpacked.
    """
    wanted = sorted({k for k in keys if k is not None})
    rounds = [wanted[a : a + KEYS_AT_ONCE] for a in range(0, len(wanted), KEYS_AT_ONCE)] + ([None] if None in keys else [])
    out = spark.createDataFrame([], f"{DOCUMENT_SCHEMA}, blocks int").drop("part")
    for some in rounds:
        if some is None:
            may, own = F.col("null_keys"), None
        else:
            may, own = F.lit(False), np.array(some, np.int64)
            for k in some:
                may |= (F.col("low_key") <= k) & (F.col("high_key") >= k)

        def pick(batches, own=own):
            for batch in batches:
                for part, base, first, payload in zip(batch["part"], batch["base"], batch["first_id"], batch["payload"]):
                    segment = Segment(payload)
                    found = np.flatnonzero(segment.null if own is None else ~segment.null & np.isin(segment.keys, own))
                    rows = [(int(part), *(segment.starts[i], segment.counts[i]), *segment.ids(segment.starts[i], segment.starts[i] + segment.counts[i])) for i in found.tolist()]
                    if rows:
                        yield pd.DataFrame({
                            "part": np.int32(part), "doc_id": pd.arrays.IntegerArray(segment.keys[found], segment.null[found]), "start": [base + first + r[1] for r in rows],
                            "n_tokens": [r[2] for r in rows], "ids": [r[3].astype("<u4").tobytes() for r in rows], "blocks": [r[4] for r in rows],
                        })

        parts = _segments(spark, path).where(may).select("part", "base", "first_id", "payload")
        out = out.union(parts.mapInPandas(pick, f"{DOCUMENT_SCHEMA}, blocks int").drop("part"))
    return out


def read_span(spark: SparkSession, path: str, start: int, stop: int) -> DataFrame:
    """The ids from ``start`` to ``stop`` (exclusive) of all files in their order: rows of start, ids (binary u32) and blocks, one a segment that holds any."""

    def cut(batches):
        for batch in batches:
            for base, first, payload in zip(batch["base"], batch["first_id"], batch["payload"]):
                ids, blocks = Segment(payload).ids(max(0, start - base - first), max(0, stop - base - first))
                if len(ids):
                    yield pd.DataFrame({"start": [max(start, base + first)], "ids": [ids.astype("<u4").tobytes()], "blocks": [blocks]})

    rows = _segments(spark, path).where((F.col("base") + F.col("first_id") < stop) & (F.col("base") + F.col("first_id") + F.col("n_ids") > start))
    return rows.select("base", "first_id", "payload").mapInPandas(cut, "start long, ids binary, blocks int")
