"""Entropy balancing against the definition: targets by hand, rates against a direct solution, copies against targets."""

import math
import re
from collections import Counter, defaultdict

import pytest

from barwright.llm import mixing
from barwright.llm.common import table
from barwright.llm.queries import QUERIES

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, source string, size string, `TARGET` int, `a.b` int"


def expected_targets(sizes):
    """sizes: {source: tokens} -> {source: target}, by resharing the excess until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(order)}
    out, free, left = {}, set(order), sum(sizes.values())
    while free:
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > 3 * sizes[s]]
        if not over:
            return out | {s: level * weight[s] for s in free}
        for s in over:
            out[s] = 3 * sizes[s]
            left -= out[s]
            free.remove(s)
    return out


def checked(rows, found):
    size = lambda t: len(SPACED.findall(t or ""))
    assert Counter((r["doc_id"], r["size"]) for r in found) == Counter((d, size(t)) for d, t, *_ in rows)
    sizes, longest = Counter(), Counter()
    for _, t, s, *_ in rows:
        sizes[s] += size(t)
        longest[s] = max(longest[s], size(t))
    wanted = expected_targets(sizes)
    source_of = defaultdict(set)
    for d, t, s, *_ in rows:
        source_of[d, size(t)].add(s)
    taken = Counter()
    for r in found:
        assert r["taken"] % r["size"] == 0 if r["size"] else r["taken"] == 0
        assert 0 <= r["taken"] <= 3 * r["size"]
        (source,) = source_of[r["doc_id"], r["size"]]
        assert r["source_size"] == sizes[source]
        assert r["target"] == pytest.approx(wanted[source])
        taken[source] += r["taken"]
    for s, t in wanted.items():
        assert abs(taken[s] - t) <= longest[s] + 1e-6 * t, s
    return wanted


def test_awkward_rows(spark):
    rows = [(k, "w " * (k % 17 * 3), ("b", "a", None, "Ä", "ab")[k % 5], "clash", k, k) for k in range(300)]
    rows += [(1000 + k, "x " * (400 * (k + 1)), "b", None, None, None) for k in range(4)]
    rows += [(5000, t, "tiny", None, None, None) for t in (None, "", " \t\n")]
    rows += [(6000, "same row here", "copies", None, None, None)] * 101
    rows += [(None, "no id", "b", None, None, None), (7000, "one\x0btwo\x1cthree four", "𝒜", None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = mixing.mix(docs).collect()
    checked(rows, found)
    assert found[0].asDict().keys() >= {"doc_id", "size", "source_size", "target", "taken"}
    again = mixing.mix(docs.repartition(3)).collect()
    assert Counter(map(tuple, found)) == Counter(map(tuple, again))


def test_rates_are_the_exponential_tilt(spark):
    rows = [(k, "w " * (1 + k * k % 37), "ab"[k % 3 == 0]) for k in range(200)]
    found = mixing.mix(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()
    for source in "ab":
        own = [r for r in found if "ab"[r["doc_id"] % 3 == 0] == source]
        mean = sum(r["size"] for r in own) / len(own)
        low, high = -200.0, 200.0
        for _ in range(200):  # bisection on the same dual
            lam = (low + high) / 2
            total = sum(min(3.0, math.exp(min(50, lam * r["size"] / mean))) * r["size"] for r in own)
            low, high = (lam, high) if total < own[0]["target"] else (low, lam)
        for r in own:
            assert r["rate"] == pytest.approx(min(3.0, math.exp(low * r["size"] / mean)), rel=1e-6)


def test_mixture_holds_the_copies(spark):
    rows = [(k, "w " * (1 + k % 9), "ab"[k % 2], k) for k in range(100)] + [(500, "a b c", "a", 0)] * 7
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, `a.b` int")
    wanted = Counter()
    for r in mixing.mix(docs).collect():
        wanted[r["doc_id"]] += r["copies"]
    got = mixing.mixture(docs)
    assert got.columns == docs.columns
    held = Counter(r["doc_id"] for r in got.collect())
    assert {d: n for d, n in held.items() if d != 500} == {d: n for d, n in wanted.items() if n and d != 500}


def test_single_source_and_empty_table(spark):
    schema = "doc_id bigint, text string, source string"
    assert mixing.mix(spark.createDataFrame([], schema)).collect() == []
    assert mixing.mixture(spark.createDataFrame([], schema)).collect() == []
    whole = mixing.mix(spark.createDataFrame([(1, "a b", None), (2, None, None)], schema)).collect()
    assert {(r["doc_id"], r["target"], r["taken"]) for r in whole} == {(1, 2.0, 2), (2, 2.0, 0)}
    bare = mixing.mix(spark.createDataFrame([(1, None, "a"), (2, "", "b")], schema)).collect()
    assert {(r["target"], r["taken"]) for r in bare} == {(0.0, 0)}


def test_query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source").collect()
    checked([tuple(r) for r in docs], QUERIES["op13_mixing"](spark, sf_dir).collect())


