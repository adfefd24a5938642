"""Surrogates in very long lines of signs, and addresses that stand close together."""

import time

from barwright.llm import surrogates


def replaced(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    return {r["doc_id"]: r for r in surrogates.replace_entities(frame, "key").collect()}


def test_long_runs_take_seconds(spark):
    lines = [sign * (1_000_000 // len(sign)) for sign in ("-", ".", "_", "a.", "%+", "x@", "a-@")]
    replaced(spark, ["warm up ann@mail.org"])
    start = time.perf_counter()
    out = replaced(spark, lines + [lines[0] + " ann@mail.org " + lines[1]])
    assert time.perf_counter() - start < 120
    assert all(out[k]["text"] == line and out[k]["n_replaced"] == 0 for k, line in enumerate(lines))
    last = out[len(lines)]
    assert last["n_replaced"] == 1 and "ann@mail.org" not in last["text"]


def test_addresses_behind_an_entity(spark):
    cases = ["a@b.com-foo@c.org", "a@b.com_foo@c.org", "a@b.com--foo@c.org", "-foo@c.org", "(-foo@c.org)", "x ..foo@c.org", "a@b.com, foo@c.org."]
    out = replaced(spark, cases)
    for k, text in enumerate(cases):
        assert out[k]["n_replaced"] == text.count("@"), text
        assert "foo@c.org" not in out[k]["text"] and "a@b.com" not in out[k]["text"], text
