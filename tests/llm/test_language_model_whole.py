"""The language model takes every token of every document."""

import math

import numpy as np

from barwright.llm import masked_lm


def test_signs_behind_words_are_tokens(spark):
    rows = [(1, "a, b. c?"), (2, "a b c"), (3, "'a' (b) c!!"), (4, ",")]
    out = masked_lm.score(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {r["doc_id"]: r["n_tokens"] for r in out.collect()} == {1: 6, 2: 3, 3: 6, 4: 1}


def test_weights_are_averaged_more_than_once():
    assert len(masked_lm.ROUNDS) > 1 and sum(share for share, _ in masked_lm.ROUNDS) >= 0.12


def corpus(spark):
    often = " ".join(f"often{k}" for k in range(masked_lm.CODES - masked_lm.HASHED))
    rare = [f"rare{k}" for k in range(600)]
    rows = [(k, often) for k in range(6)] + [(6, " ".join(rare)), (7, " ".join(rare[:300] * 3))]
    rows += [(100 + k, w) for k, w in enumerate(rare)]
    return spark.createDataFrame(rows, "doc_id bigint, text string"), rare


def test_rare_tokens_have_probabilities_of_their_own(spark, monkeypatch):
    docs, rare = corpus(spark)
    scored = {r["doc_id"]: r["token_log_prob"] for r in masked_lm.score(docs).collect()}
    buckets = {}
    for k, w in enumerate(rare):
        buckets.setdefault(masked_lm.bucket(w.encode()), []).append(k)
    pairs = [(a, b) for ks in buckets.values() for a in ks for b in ks if a < 300 <= b]
    assert pairs
    # Alone in a text: the same code, five mentions against two.
    assert all(abs(scored[100 + a] - scored[100 + b] - math.log(5 / 2)) < 1e-4 for a, b in pairs)
    # Counts that are joined say the same as counts in the workers.
    monkeypatch.setattr(masked_lm, "_KNOWN", 800)
    joined = {r["doc_id"]: r["token_log_prob"] for r in masked_lm.score(docs).collect()}
    assert joined.keys() == scored.keys() and all(abs(joined[k] - scored[k]) < 1e-3 for k in scored)


def test_probabilities_of_all_tokens_sum_to_one(spark):
    vocab, counted = masked_lm.vocabulary(corpus(spark)[0])
    assert counted.count() == len(vocab.words)
    of_codes = np.bincount(vocab.code[: len(vocab.words)], weights=np.exp(vocab.weight[: len(vocab.words)]), minlength=masked_lm.CODES)
    assert np.allclose(of_codes[vocab.of_code > 0], 1)


def test_log_probabilities_by_products_equal_the_softmaxes():
    rng = np.random.default_rng(4)
    model = masked_lm.Model(share=rng.dirichlet(np.ones(masked_lm.CODES)))
    model.parts["given"][:] += rng.normal(0, 1, model.parts["given"].shape)
    stream, at = masked_lm.joined_stream([rng.integers(0, masked_lm.CODES, n) for n in (1, 0, 5_000, 30)])
    for scale in (1, 20, 2_000):  # the last one needs scaling of exp()
        model.parts["out"][:] *= scale
        plain = model._forward([stream[at + o] for o in masked_lm.OFFSETS], stream[at])[3]
        assert np.allclose(model.log_probs(stream, at), plain, rtol=1e-4, atol=1e-4)


def test_encoded_documents_hold_every_token(spark):
    docs, _ = corpus(spark)
    docs = docs.union(spark.createDataFrame([(900, None), (901, ""), (902, "often1 never-seen-before")], docs.schema))
    vocab, _ = masked_lm.vocabulary(corpus(spark)[0])
    rows = {r["doc_id"]: r for r in masked_lm.encoded(docs, vocab).collect()}
    assert len({r["row"] for r in rows.values()}) == docs.count() == len(rows)
    code = dict(zip(vocab.words, vocab.code))
    for r in docs.collect():
        want = [t for piece in (r["text"] or "").encode().split() for t in masked_lm.parts_of(piece) if t]
        got = rows[r["doc_id"]]
        assert got["n_tokens"] == len(want) and [bytes(t) for t in got["rare"]] == [t for t in want if t not in code]
        own = masked_lm.CODES - masked_lm.HASHED
        assert np.frombuffer(got["codes"], "<i2").tolist() == [code.get(t, own + masked_lm.bucket(t)) for t in want]


def test_rounds_mask_every_place_once(spark):
    rng = np.random.default_rng(9)
    texts = [rng.integers(0, masked_lm.CODES, n) for n in (0, 1, 700, 3, 4_000)]
    stream, at = masked_lm.joined_stream(texts)
    ends = np.cumsum([0.0, *(share for share, _ in masked_lm.ROUNDS)])
    drawn = [masked_lm.masked(texts, stream, at, a, b) for a, b in zip(ends, ends[1:])]
    assert sorted(np.concatenate(drawn).tolist()) == at.tolist() and all(len(d) for d in drawn)
    # Which texts are taken together changes no draw.
    alone = masked_lm.joined_stream(texts[4:])
    assert len(masked_lm.masked(texts[4:], *alone, ends[0], ends[1])) == (drawn[0] > at[703]).sum()
