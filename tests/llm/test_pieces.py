import math
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st

from strata.llm.piece_sampling import PieceSampler, row_seeds, sample_pieces
from strata.llm.spans import mixed

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def sampler():
    return PieceSampler(PATH)


@given(st.lists(st.text(max_size=30), min_size=1, max_size=4))
@settings(max_examples=60, deadline=None)
def test_decoding_is_lossless(texts):
    sampler = PieceSampler(PATH)
    for text, ids in zip(texts, sampler.encode(texts, np.arange(len(texts), dtype=np.uint64))):
        assert sampler.decode(ids) == text


def test_the_library_decodes_samples(sampler):
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for text in ("hello wide world", "two  spaces\n\nand é 日本 😀", ""):
        assert model.decode(sampler.encode([text], np.zeros(1, np.uint64))[0].tolist()) == text


def test_draws_follow_the_paths_probabilities(sampler):
    text = "hello"
    weight = {sampler._flat[sampler._at[k] : sampler._at[k] + sampler._size[k]].tobytes().decode(): w for k, w in zip(sampler._piece, sampler._weight)}
    paths: dict = {}

    def walk(at, path, w):
        if at == len(text) + 1:
            paths[path] = math.exp(w)
        for end in range(at + 1, len(text) + 2):
            if (p := f" {text}"[at:end]) in weight:
                walk(end, (*path, p), w + weight[p])

    walk(0, (), 0.0)
    n, total = 40_000, sum(paths.values())
    spelt = lambda k: sampler._flat[sampler._at[k] : sampler._at[k] + sampler._size[k]].tobytes().decode()
    seen = Counter(tuple(map(spelt, ids)) for ids in sampler.encode([text] * n, mixed(np.arange(n, dtype=np.uint64))))
    assert set(seen) <= set(paths)
    for path, p in paths.items():
        p /= total
        assert abs(seen[path] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-4


def test_rows_draw_the_same_in_any_batch_and_differ_by_key(sampler):
    text = "some words that can be cut in many ways " * 4
    seeds = row_seeds(pd.Series([1, 2, 0, 1]), pd.Series([False, False, True, False]), 7)
    a, b, _, d = sampler.encode([text] * 4, seeds)
    assert (a == d).all() and (len(a) != len(b) or (a != b).any())
    assert (sampler.encode(["other", text], np.array([5, seeds[0]], np.uint64))[1] == a).all()


def test_edge_rows(edge_docs, edge_rows, no_docs):
    got = sample_pieces(edge_docs, PATH).collect()
    assert sorted((str(r.doc_id), r.decoded) for r in got) == sorted((str(r[0]), r[1] or "") for r in edge_rows)
    assert len({(r.doc_id, r.decoded, bytes(r.ids)) for r in got if r.doc_id == 13}) == 1
    assert sample_pieces(no_docs, PATH).count() == 0
