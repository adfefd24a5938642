"""Benchmark decontamination: Wu-Manber multi-pattern search over words.

Patterns are the windows of `window` consecutive words of every benchmark item (an item of fewer words is one window).
Patterns of similar length share one matcher. For the first m words of its patterns (m: the shortest), a shift table
says for each block of two words how far the search may move on; a shift of zero leads to the bucket of the patterns that
end in that block, and each of them is compared word by word.

Defined results: null or empty texts have no words and are never hit. Null or wordless items give no pattern. Repeated
rows give repeated results; items with equal texts are all reported. Extra columns are ignored. Benchmarks of more than
`block_bytes` are searched in blocks, one pass over the documents each, so memory does not grow with the benchmark.
"""

from __future__ import annotations

import hashlib
import uuid
from collections import defaultdict
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barwright.llm.common import fresh, named, per_batch, plain_words, text_key, texts_of, worker_cache

#: Shortest pattern lengths of the matchers; a pattern belongs to the largest that it reaches.
_CLASSES = (13, 8, 4, 2, 1)


class WuManber:
    """Finds all occurrences of word sequences."""

    def __init__(self, patterns: Iterable[tuple[bytes, ...]]):
        self.patterns = list(patterns)
        self.m = min(map(len, self.patterns))
        self.block = min(2, self.m)
        self.far = self.m - self.block + 1
        self.shift: dict = {}
        self.buckets: dict = defaultdict(list)
        for k, p in enumerate(self.patterns):
            for end in range(self.block, self.m + 1):
                b = p[end - self.block : end]
                self.shift[b] = min(self.shift.get(b, self.far), self.m - end)
            self.buckets[p[self.m - self.block : self.m]].append((p[0], len(p), k))

    def find(self, words: list[bytes]) -> list[tuple[int, int, int]]:
        """(start, end, pattern number) of each occurrence."""
        found = []
        m, far, shift, pair = self.m, self.far, self.shift.get, self.block == 2
        at, n = m - 1, len(words)
        while at < n:
            block = (words[at - 1], words[at]) if pair else (words[at],)
            step = shift(block, far)
            if step:
                at += step
                continue
            start = at - m + 1
            for first, size, k in self.buckets[block]:
                if words[start] == first and tuple(words[start : start + size]) == self.patterns[k]:
                    found.append((start, start + size, k))
            at += 1
        return found


class Matcher:
    """Wu-Manber matchers by pattern length, and the items of each pattern."""

    def __init__(self, items: Iterable[tuple[str, bytes]], window: int):
        owners: dict[tuple[bytes, ...], set[str]] = defaultdict(set)
        for item, text in items:
            words = plain_words(text)
            for i in range(max(1, len(words) - window + 1) if words else 0):
                owners[tuple(words[i : i + window])].add(item)
        by_class = defaultdict(list)
        for p in owners:
            by_class[next(c for c in _CLASSES if len(p) >= c)].append(p)
        self.matchers = [WuManber(p) for p in by_class.values()]
        self.owners = [[owners[p] for p in m.patterns] for m in self.matchers]

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Disjoint hit intervals in order, and the items found."""
        spans, items = [], set()
        for matcher, owners in zip(self.matchers, self.owners):
            for start, end, k in matcher.find(words):
                spans.append((start, end))
                items |= owners[k]
        return merged(spans), items


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


_FOUND = pa.struct(
    [
        ("n_words", pa.int64()),
        ("spans", pa.list_(pa.struct([("first", pa.int64()), ("stop", pa.int64())]))),
        ("items", pa.list_(pa.string())),
    ]
)


def _finder(spark: SparkSession, items: list[tuple[str, bytes]], window: int):
    sent, name = spark.sparkContext.broadcast(items), f"matcher-{uuid.uuid4().hex}"

    def find(text: pa.Array) -> pa.Array:
        matcher, rows = worker_cache(name, lambda: Matcher(sent.value, window)), []
        for t in texts_of(text):
            words = plain_words(t)
            spans, items = matcher.find(words)
            rows.append(
                {"n_words": len(words), "spans": [{"first": a, "stop": b} for a, b in spans], "items": sorted(items)}
            )
        return pa.array(rows, _FOUND)

    return per_batch(find, _FOUND)


def _joined(n_words: pa.Array, spans: pa.Array, items: pa.Array) -> pa.Array:
    rows = []
    for n, s, i in zip(n_words.to_pylist(), spans.to_pylist(), items.to_pylist()):
        whole = merged((x["first"], x["stop"]) for x in s or ())
        rows.append({"n_words": n, "spans": [{"first": a, "stop": b} for a, b in whole], "items": sorted(set(i or ()))})
    return pa.array(rows, _FOUND)


def _digest(items: pa.Array) -> pa.Array:
    return pa.array([hashlib.sha256(",".join(x or ()).encode()).hexdigest() for x in items.to_pylist()], pa.string())


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = 13,
    block_bytes: int = 8 << 20,
    into: str = "found",
) -> DataFrame:
    """docs with a struct column: number of words, hit word intervals [first, stop) and the items found, sorted as strings."""
    spark = docs.sparkSession
    items = benchmark.select(
        named(benchmark, item).cast("string").alias("item"), named(benchmark, item_text).cast("binary").alias("text")
    ).where("item is not null and text is not null")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()["b"]
    n_blocks = max(1, -(-size // block_bytes))
    block = F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks))

    def finder(k: int):
        rows = items.where(block == k).collect()  # about block_bytes
        return _finder(spark, [(r["item"], bytes(r["text"])) for r in rows], window)

    body = named(docs, text)
    if n_blocks == 1:
        return docs.withColumn(into, finder(0)(body))
    (key,) = fresh(docs, "__text_key")
    parts = None
    for k in range(n_blocks):
        part = docs.select(text_key(body).alias(key), finder(k)(body).alias("f")).where(F.size("f.spans") > 0)
        part = part.groupBy(key).agg(F.first("f").alias("f"))  # copies of a text say the same
        parts = part if parts is None else parts.unionByName(part)
    hits = parts.groupBy(key).agg(F.flatten(F.collect_list("f.spans")).alias("s"), F.flatten(F.collect_list("f.items")).alias("i"))
    n_words = _finder(spark, [], window)(body)
    left = docs.withColumn(key, text_key(body)).withColumn(into, n_words)
    spans, found_items = fresh(left, "__spans", "__items")
    hits = hits.withColumnsRenamed({"s": spans, "i": found_items})
    joined = left.join(hits, key, "left")
    return joined.withColumn(into, per_batch(_joined, _FOUND)(F.col(f"{into}.n_words"), spans, found_items)).select(
        *[named(joined, c) for c in docs.columns], into
    )


def n_hit(found: Column) -> Column:
    return F.aggregate(found["spans"], F.lit(0).cast("bigint"), lambda n, s: n + s["stop"] - s["first"])


def is_contaminated(found: Column) -> Column:
    """At least one hit, and at least a twentieth of the words hit."""
    hit = n_hit(found)
    return (hit > 0) & (hit * 20 >= found["n_words"])


def contamination(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """One row per document: how much of it stands in the benchmark."""
    found = find_passages(docs.select("doc_id", "text"), benchmark, **how)
    f = F.col("found")
    return found.select(
        "doc_id",
        f["n_words"].alias("n_words"),
        n_hit(f).alias("n_hit"),
        F.size(f["items"]).cast("bigint").alias("n_items"),
        per_batch(_digest, pa.string())(f["items"]).alias("items_sha256"),
        is_contaminated(f).alias("contaminated"),
        f["spans"].alias("spans"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    (into,) = fresh(docs, "__found")
    found = find_passages(docs, benchmark, into=into, **how)
    return found.where(~is_contaminated(F.col(into))).select(*[named(found, c) for c in docs.columns])
