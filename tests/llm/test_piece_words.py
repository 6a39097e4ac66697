"""op2's words: each distinct one is encoded once for many texts, and merging by kept ranks is merging pair by pair."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers

from carepulse.llm import sentencepiece_bpe

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def test_distinct_words_are_encoded_once(monkeypatch):
    own = sentencepiece_bpe.MergeCodec(PIECES)
    met, backtrack = [], own.backtrack
    monkeypatch.setattr(own, "backtrack", lambda part: met.append(part) or backtrack(part))
    texts = ["the thanor, ereinte.\nthe thanor", "", "ereinte. the\nthanor, thanor", "a  b \x00 the", "日本 the \x01 é"] * 30
    assert [np.frombuffer(b, "<u4").tolist() for b in own.encode_all(texts)] == [own.sp.encode(t, add_bos=True, add_eos=True) for t in texts]
    assert len(met) == len(set(met))


def test_results_do_not_depend_on_what_is_kept_or_looked_at_together(monkeypatch):
    rng = random.Random(8)
    parts = ["th", "an", "er", "ing", " ", " ", "  ", "\n", ".", ",", "é", "日本", "🤗", "▁", "\x00", "\t", "12", "<s>", "A", "ﬁ"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(1500)]
    own = sentencepiece_bpe.MergeCodec(PIECES, cache_entries=100)
    monkeypatch.setattr(sentencepiece_bpe, "TOGETHER", 700)
    for t, ids in zip(texts, own.encode_all(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == own.sp.encode(t, add_bos=True, add_eos=True), repr(t)


def test_merging_keeps_the_order_of_scores():
    own, rng = sentencepiece_bpe.MergeCodec(PIECES), random.Random(4)

    def pair_by_pair(text: str) -> list[str]:
        parts = list(text)
        while True:
            found = [(own.rank[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in own.rank]
            if not found:
                return parts
            i = min(found)[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]

    pieces = list(own.ids)
    for _ in range(3000):
        text = rng.choice(pieces) + rng.choice(pieces)
        assert own.merged(text) == pair_by_pair(text)


def test_words_cut_between_letters_equal_library():
    own, rng = sentencepiece_bpe.MergeCodec(PIECES, cache_entries=300), random.Random(8)
    assert own.apart.any() and not any(own.apart[ord(c), ord(d)] for p in own.ids for c, d in zip(p, p[1:]) if max(c, d) < "\u0250")
    letters = [chr(c) for c in range(0x41, 0x250) if chr(c).isalpha()] + list("aeionrst") * 40 + list("$#%&*'-\"=_0123")
    texts = [" ".join("".join(rng.choices(letters, k=rng.randint(1, 14))) for _ in range(rng.randint(0, 30))) for _ in range(300)]
    for text, ids in zip(texts, own.encode_all(texts)):
        want = own.sp.encode(text, add_bos=True, add_eos=True)
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert own.decode(ids) == own.sp.decode(want)


def test_a_text_is_encoded_once(spark):
    from carepulse.llm import queries
    plan = queries.op2_sentencepiece(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "pythonUDF0" in plan and "pythonUDF1" not in plan
    docs = spark.createDataFrame([(1, "a b"), (2, None), (2, "ñr ü$$$"), (None, " x ")], "doc_id long, text string")
    both = sentencepiece_bpe.decode(sentencepiece_bpe.encode(docs, PIECES), PIECES)
    assert sorted(map(str, sentencepiece_bpe.round_trip(docs, PIECES).collect())) == sorted(map(str, both.collect()))
