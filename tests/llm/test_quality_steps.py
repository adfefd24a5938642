"""The ladder of the quality rules: certificates per stratum, the promise on unseen labels, verdicts against a plain version."""

import math
import random
import zlib

from pyspark.sql import functions as F

from barwright.llm import quality_rules as q


def test_levels_are_handed_on():
    clean, n = [0] * 28, {"a": 5000, "b": 120, "c": 86, "d": 40}
    # 40 labels cannot refute 5 % at any level that is left: d takes no part. The others need log(3 / 0.05) / -log(0.95) = 80.
    found = q.certified_steps({s: clean for s in n}, n, 0.05, 0.05)
    assert found == {"a": 27, "b": 27, "c": 27}
    # One loss among 100 refutes 5 % at 0.0371 only: not at a third of 0.05, but at the whole of it, handed on by the others.
    one = [0] * 10 + [1] * 18
    tail = q.binomial_tail(1, 100, 0.05)
    assert 0.05 / 3 < tail < 0.05
    assert q.certified_steps({"a": clean, "b": clean, "c": one}, {"a": 5000, "b": 5000, "c": 100}, 0.05, 0.05)["c"] == 27
    stuck = [0] * 5 + [4000] * 23
    assert q.certified_steps({"a": stuck, "b": stuck, "c": one}, {"a": 5000, "b": 5000, "c": 100}, 0.05, 0.05) == {"a": 4, "b": 4, "c": 9}
    assert q.certified_steps({}, {}, 0.05, 0.05) == {}


def corpus():
    """Three languages of plain documents; a tenth shouts, repeats or is full of signs, and is labelled bad."""
    r = random.Random(8)
    rows, labels = [], []
    for k in range(3000):
        words = [f"w{r.randrange(4000)}" for _ in range(r.randint(30, 60))]
        text, good = " ".join(words), 1
        if r.random() < 0.1:
            good = 0
            text = r.choice([text.upper(), text + " #$%&" * 20, " ".join(w + "!!!" for w in words)])
        elif r.random() < 0.02:
            text += " Hey!"
        rows.append((k, text, ("aa", "bb", "cc")[k % 3 if k % 7 else 0]))
        if r.random() < 0.5:
            labels.append((k, good))
    return rows, labels


def test_certificates_and_verdicts(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    out = q.apply_rules(docs, spark.createDataFrame(labels, "doc_id bigint, quality int")).collect()
    good = dict(labels)
    judged = [r for r in out if not r["base_failed"]]
    seen = {k for k, label in labels if label == 1 and zlib.crc32(str(k).encode()) % 5}
    kept = {r["doc_id"]: r["kept"] for r in judged}
    for lang in ("aa", "bb", "cc"):
        own = [r for r in judged if r["stratum"] == lang]
        # Every language has a certificate: most of its bad documents go.
        bad = [r for r in own if good.get(r["doc_id"]) == 0]
        assert sum(not r["kept"] for r in bad) > 0.5 * len(bad)
        # The promise, on labels that the cutoffs never saw.
        held = [r for r in own if good.get(r["doc_id"]) == 1 and r["doc_id"] not in seen]
        assert sum(not r["kept"] for r in held) <= 0.05 * len(held) + 3 * math.sqrt(0.05 * len(held))
    # The same verdicts from the definition: quantiles by sorting, steps by counting.
    for lang in ("aa", "bb", "cc"):
        own = [r for r in judged if r["stratum"] == lang]
        others = [r for r in own if r["doc_id"] not in seen]
        calib = [r for r in own if r["doc_id"] in seen]
        steps = []
        for share in q.LADDER:
            at = max(1, math.ceil((1 - share) * len(others) - 1e-9)) - 1
            cuts = {m: sorted(r[m] for r in others)[at] for m in q.MEASURES}
            lost = sum(any(r[m] > cuts[m] for m in q.MEASURES) for r in calib)
            steps.append((cuts, lost))
        step = q.strictest([lost for _, lost in steps], len(calib), 0.05, 0.05 / 3)
        cuts = steps[step][0]
        assert all(kept[r["doc_id"]] == (not any(r[m] > cuts[m] for m in q.MEASURES)) for r in own)


def test_no_labels_and_no_documents(spark):
    docs = spark.createDataFrame([(1, "word " * 20, None), (2, None, "aa")], "doc_id bigint, text string, lang string")
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    out = q.apply_rules(docs, none)
    assert out.where(F.col("kept") == F.col("base_failed")).isEmpty()
    assert q.apply_rules(docs.limit(0), none).collect() == []
