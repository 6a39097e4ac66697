"""op7's words: plain ones never reach the library's encoder, all others give its ids; the reading side is one Python step."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers

from carepulse.llm import queries, token_store

BYTES = public_tokenizers.path("byte_bpe_50k.json")


def test_plain_words_go_to_the_merges(monkeypatch):
    text = "Thorngret the quorvine, andez.\nOnnestuou then;\nünter straße ǅelo: endoftext!"
    own = token_store.WordTokens(BYTES)
    expected = [np.array(own.tokenizer.encode(t, add_special_tokens=False).ids, dtype=own.dtype).tobytes() for t in (text, text[3:])]
    asked: list = []
    library = own._ids
    monkeypatch.setattr(own, "_ids", lambda texts: asked.extend(texts) or library(texts))
    monkeypatch.setattr(own, "_row", lambda words: [library([w.decode()])[0] for w in words if not asked.append(w)])
    assert own.encode([text, text[3:]]) == expected
    assert [t for t in asked if t] == ["\n"]


def test_odd_texts_as_the_library():
    rng = random.Random(11)
    parts = [*"abcXYZ éñßǅɏɐλя中 \n\n\t\r\x0b\x1c\x85\xa0 　.,;:!?'-_*#%0123456789½\x00😀", " the", "'s", "'re", "  ", "\n ", " \n", "<|endoftext|>", "word", "\n", " ", "., "]
    own = token_store.WordTokens(BYTES, cache_entries=200)
    texts = ["", " ", "\n", "a\n", "\na", "a\nb", "a\n\nb", "a \nb", "a.\nb", "a b\nc", "\x00", "a\x00 b"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(3000)]
    for again in range(2):
        found = own.encode(texts)
        for t, ids in zip(texts, found):
            assert np.frombuffer(ids, own.dtype).tolist() == own.tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_checksums_are_made_without_a_second_python_step(spark, tmp_path):
    spark.createDataFrame([(1, "one two"), (2, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    plan = queries.op7_token_store(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "ArrowEvalPython" not in plan
