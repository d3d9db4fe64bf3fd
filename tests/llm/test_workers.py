"""What Python workers keep and give back, and which steps need none."""

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strata.llm import tokens
from strata.llm.multiset_hash import fingerprint_edits

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_common_words_outlast_a_full_cache(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 40)
    tok = Tokenizer.from_file(PATH)
    encoder = tokens.CachedEncoder(PATH)
    learn, learnt = encoder._learn, []
    monkeypatch.setattr(encoder, "_learn", lambda words: (learnt.extend(words), learn(words))[1])
    for k in range(40):
        text = f"common words\nstay " + " ".join(f"only{k}x{i}" for i in range(7)) + " é 99"
        (ids,) = encoder.encode([text])
        assert np.frombuffer(ids, "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids
        assert len(encoder._known.hashes) <= 20 + 30 and len(encoder._older.hashes) <= 20 + 30
    assert learnt.count(b"common") == 1 and learnt.count(b" words") == 1 and learnt.count(b" \xc3\xa9") == 1
    assert b"\n" not in learnt


def test_a_step_gives_back_what_it_freed():
    def step(batches):
        for n in batches:
            held = pa.array(np.zeros(n))
            yield len(held)

    assert list(tokens.tidied(step)(iter([3, 1_000_000, 0]))) == [3, 1_000_000, 0]
    assert list(tokens.tidied(step)(iter([]))) == []


def test_the_next_document_is_found_without_python_workers(spark):
    docs = spark.range(0, 300, 1, 3).select(F.col("id").alias("doc_id"), F.concat(F.lit("some text\nline "), "id").alias("text"))
    out = fingerprint_edits(docs)
    plan = out._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("ExistingRDD", "LogicalRDD", "MapInPandas", "Python"))
    assert out.count() == 300 and out.where("near_next between 0 and 1").count() == 300
