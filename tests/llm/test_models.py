"""Held-out figures of the trained models, the registered queries and the pipeline on the given small tables."""

import numpy as np
import pyarrow.parquet as pq
import pytest
from oracle import connect, differences

import __spark_entry__ as registered
import corpus_pipeline
from barwright.llm import masked_lm, quality_net, queries
from barwright.llm.common import fresh

TABLES = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = queries.op2_quality_net(spark, TABLES).where("held_out").collect()
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{TABLES}/labels.parquet").to_pylist()}
    known = [(labels[r["doc_id"]], r["score"], r["predicted"]) for r in rows if labels.get(r["doc_id"]) is not None]
    good = [s for q, s, _ in known if q == 1]
    bad = [s for q, s, _ in known if q == 0]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.95 and np.mean([q == p for q, _, p in known]) > 0.9


def test_temperature_makes_scores_calibrated():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 6))
    y = (rng.random(4000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(float)
    net = quality_net.Net(x, y, epochs=10)
    score = net.score(x)
    for low in (0.2, 0.4, 0.6):
        inside = (score >= low) & (score < low + 0.2)
        assert abs(score[inside].mean() - y[inside].mean()) < 0.08


def test_gradient_of_the_language_model():
    rng = np.random.default_rng(0)
    stream, at = masked_lm.joined_stream([rng.integers(0, masked_lm.CODES, 30)])
    model = masked_lm.Model()
    before = model.log_probs(stream, at).sum()
    for _ in range(30):
        model.step(stream, at, np.full(model.flat.shape, 1e-3), 0.02)
    assert model.log_probs(stream, at).sum() > before


def test_probabilities_sum_to_one():
    model = masked_lm.Model()
    stream = np.array([masked_lm.CODES] * 2 + [5, 9, 11] + [masked_lm.CODES] * 2)
    total = 0.0
    for code in range(masked_lm.CODES):
        stream[3] = code
        total += np.exp(model.log_probs(stream, np.array([3]))[0])
    assert abs(total - 1) < 1e-3


def test_language_model_learns_from_the_corpus(spark):
    rows = queries.op3_masked_lm(spark, TABLES).collect()
    mean = sum(r["log_prob"] for r in rows) / sum(r["n_tokens"] for r in rows)
    assert mean > -np.log(masked_lm.CODES) + 0.3


def test_pipeline(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet").withColumn("__score", docs_clash())
    n = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, TABLES)
        assert out.columns == docs.columns, name
        kept = out.count()
        assert 0 < kept <= n
        docs, n = out, kept
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, TABLES)
    assert packed.select("doc_id").distinct().count() == n


def docs_clash():
    from pyspark.sql import functions as F

    return F.lit("taken")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_counterpart(spark, name):
    tables = TABLES.replace("0.01", "0.001")
    assert differences(queries.QUERIES[name](spark, tables), connect(tables), queries.ORACLES[name]) == []


def test_fresh_names(spark):
    assert fresh(spark.createDataFrame([(1, 2)], "Score int, score_ int"), "score", "score") == ["score__", "score___"]


def test_registration():
    assert set(queries.QUERIES) | {"pipeline"} <= set(registered.queries())
    assert [f"op{n}_" in " ".join(queries.QUERIES) for n in range(1, 11)] == [True] * 10


@pytest.mark.parametrize("name", ["localCheckpoint", "crossJoin", "tempfile", ".sample("])
def test_no_shortcuts_in_the_sources(name):
    import pathlib

    root = pathlib.Path(corpus_pipeline.__file__).parent
    for path in [*root.glob("barwright/llm/*.py"), root / "corpus_pipeline.py"]:
        assert name not in path.read_text(), path
