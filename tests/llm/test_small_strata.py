"""Strata without a certificate of their own lose nothing to the quality rules."""

from barwright.llm import quality_rules


def test_small_strata_have_no_cutoffs(spark):
    plain = " ".join(f"word{k}" for k in range(40))
    loud = plain.upper()
    rows = [(k, plain, "en") for k in range(3000)] + [(3000 + k, loud, "es") for k in range(5)] + [(4000, loud, "xx"), (4001, loud, "en")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(k, 1) for k in range(3005)], "doc_id bigint, quality int")
    out = {r["doc_id"]: r["kept"] for r in quality_rules.apply_rules(docs, labels).collect()}
    assert all(kept for k, kept in out.items() if k != 4001)
    assert not out[4001]  # a stratum with enough labels has its rule
