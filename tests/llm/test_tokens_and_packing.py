import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strata.llm.packing import best_fit, cut_pieces, fit_repeats, pack_documents, plan_packing
from strata.llm.token_files import BLOCK, pack_ids, read_documents, read_span, read_token_files, unpack_ids, write_token_files
from strata.llm.tokens import CachedEncoder
from strata.session import scratch_path

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    tok = Tokenizer.from_file(PATH)
    tok.encode_special_tokens = True
    return lambda t: tok.encode(t or "", add_special_tokens=False).ids


@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=700), st.integers(0, 6), st.integers(1, 3))
@settings(max_examples=60, deadline=None)
def test_blocks_round_trip_whole_and_by_block(ids, first, n):
    a = np.array(ids, np.uint32)
    index, blocks = pack_ids(a)
    assert (unpack_ids(index, blocks, len(a)) == a).all()
    if first * 128 < len(a):
        assert (unpack_ids(index, blocks, len(a), first, n) == a[first * 128 : (first + n) * 128]).all()


@pytest.mark.parametrize("text", ["", " ", "a  b\n\n c\t d  ", "it's we'll 12 ab3,,é!!x", "<|endoftext|> z", "日本 x y", "a\nb c", "Œuf ×÷ ªº", "x" * 3000])
def test_encoder_equals_the_library(plain, text):
    encoder = CachedEncoder(PATH)
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode([text, "b " + text, text])] == [plain(text), plain("b " + text), plain(text)]


def test_token_files_of_edge_rows(spark, edge_docs, edge_rows, no_docs, plain):
    path = scratch_path(spark, "t")
    write_token_files(edge_docs, path, PATH)
    got = sorted(((r.doc_id is not None, r.doc_id or 0, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in read_token_files(spark, path).collect()), key=lambda x: x[2])
    want, start = [], 0
    for key, text in sorted(((r[0], r[1]) for r in edge_rows), key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or "")):
        ids = [*plain(text), 0]
        want.append((key is not None, key or 0, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want
    path = scratch_path(spark, "t")
    write_token_files(no_docs, path, PATH)
    assert read_token_files(spark, path).count() == 0


@pytest.fixture(scope="module")
def many(spark):
    """Files of 30,000 documents in small segments, and all that a full read gives."""
    from strata.llm import token_files

    own, token_files.SEGMENT_IDS = token_files.SEGMENT_IDS, 1 << 14
    path = scratch_path(spark, "many")
    rows = [(3 * i, " ".join(f"w{(i * 37 + k * 11) % 900}" for k in range(40 + i % 60))) for i in range(30_000)] + [(None, "no key"), (None, None), (30, "again the key thirty")]
    write_token_files(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), path, PATH)
    token_files.SEGMENT_IDS = own
    return path, read_token_files(spark, path).collect()


def test_a_hundred_documents_unpack_few_blocks(spark, many):
    path, every = many
    wanted = [3 * i for i in range(0, 30_000, 303)] + [30, 31, None]
    got = read_documents(spark, path, wanted).collect()
    as_rows = lambda rows: sorted((str(r.doc_id), r.start, r.n_tokens, bytes(r.ids)) for r in rows)
    assert as_rows(got) == as_rows([r for r in every if r.doc_id in wanted]) and len(got) > 100
    assert sum(r.blocks for r in got) < 0.01 * sum(r.n_tokens for r in every) / BLOCK
    assert read_documents(spark, path, []).count() == 0 and read_documents(spark, path, [1, -5]).count() == 0


def test_a_read_by_key_prunes_segments_by_the_files_statistics(spark, many):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = read_documents(spark, many[0], [3, 300])._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "LessThanOrEqual(low_key,3)" in plan and "GreaterThanOrEqual(high_key,300)" in plan


def test_a_range_of_ids(spark, many):
    path, every = many
    flat = b"".join(bytes(r.ids) for r in sorted(every, key=lambda r: r.start))
    for start, stop in ((0, 5), (1000, 1001), (40_000, 90_000), (len(flat) // 4 - 10, len(flat) // 4 + 50), (7, 7)):
        got = sorted(read_span(spark, path, start, stop).collect(), key=lambda r: r.start)
        assert b"".join(bytes(r.ids) for r in got) == flat[4 * start : 4 * stop]
        assert sum(r.blocks for r in got) <= (stop - start) // BLOCK + 2 * len(got)


def test_rows_of_one_key_spread_over_all_tasks_in_order(spark):
    rows = [(7, f"text {k % 900}") for k in range(2000)] + [(7, "copy")] * 1000 + [(k, "x y") for k in range(100, 3100)] + [(None, None)] * 500
    path = scratch_path(spark, "hot")
    write_token_files(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), path, PATH)
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy("part").agg(F.sum("n_ids").alias("count")).collect()]
    assert len(sizes) == 4 and max(sizes) < 3 * min(sizes)
    got = sorted(read_token_files(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((k for k, _ in rows), key=lambda k: (k is not None, k or 0))


def test_cut_pieces():
    assert cut_pieces(1, 8) == [(0, 1)] and cut_pieces(8, 8) == [(0, 8)] and cut_pieces(17, 8) == [(0, 1), (1, 8), (9, 8)]


@given(st.lists(st.integers(1, 64), max_size=80))
@settings(max_examples=60, deadline=None)
def test_plan_uses_every_piece_once_and_fits(lengths):
    counts = np.bincount(lengths, minlength=65) if lengths else np.zeros(65, int)
    plan = plan_packing(counts, 64)
    used = np.zeros(65, int)
    for pattern, times in plan:
        assert sum(pattern) <= 64 and times > 0
        for n in pattern:
            used[n] += times
    counts[64] = 0
    assert (used == counts).all()


def test_least_squares_finds_exact_repeats_and_beats_no_packing():
    counts = np.zeros(11, int)
    counts[[7, 3]] = 100
    assert abs(fit_repeats([(7, 3)], counts)[0] - 100) < 1e-6
    counts[[6, 4, 2, 8]] = 50
    assert sum(n for _, n in plan_packing(counts, 10)) == 200  # 100 of 7 + 3, 50 of 6 + 4, 50 of 8 + 2
    assert sum(n for _, n in best_fit(counts, 10)) == 200


def test_packing_of_edge_rows(edge_docs, edge_rows, no_docs, plain):
    rows = pack_documents(edge_docs, PATH, size=256).collect()
    total = sum(len(plain(r[1])) + 1 for r in edge_rows)
    assert sum(r.length for r in rows) == total
    by_sequence: dict = {}
    for r in rows:
        assert len(r.ids) == 4 * r.length and r.length <= 256
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        places.sort()
        ends = np.cumsum([n for _, n in places])
        assert [o for o, _ in places] == [0, *ends[:-1].tolist()] and ends[-1] <= 256
    long = sorted((r.piece, r.start, r.length, r.ids) for r in rows if r.doc_id == 6)
    assert b"".join(x[3] for x in long) == np.array([*plain(edge_rows[5][1]), 0], "<u4").tobytes()
    assert all(x[2] == 256 for x in long[1:])
    assert pack_documents(no_docs, PATH).count() == 0
