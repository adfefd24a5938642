"""Packing into optimal length buckets.

Documents longer than `max_len` are cut into segments of that length. One aggregation gives the histogram of segment lengths
(at most max_len + 1 rows). Dynamic programming over it picks the bucket boundaries with the least padding, exactly. Inside
each bucket, segments in a hashed order fill batches of at most `token_budget` tokens, padding included. Ranks inside a
bucket are counted per part of bounded size and shifted by the counts of earlier parts, so no bucket meets in one task.

Defined results: null and empty texts are one segment of length 0 in the smallest bucket. Rows equal in id, text and length are
counted together and dealt out one by one at the end. Equal ids with different texts stay apart. An empty table gives no
rows. Extra columns are ignored. A length of null counts as 0.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barwright.llm.common import durable

#: Segments that one part of a bucket holds, about.
PART_ROWS = 200_000


def word_length(text: Column) -> Column:
    """Words of a text, split at ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))


def optimal_boundaries(histogram: dict[int, int], n_buckets: int) -> list[int]:
    """Bucket lengths, ascending, the last one the greatest length: the choice of at most n_buckets with the least padding."""
    if not histogram:
        return []
    lengths = np.array(sorted(histogram), dtype=np.float64)
    counts = np.array([histogram[int(x)] for x in lengths], dtype=np.float64)
    n = len(lengths)
    c = np.concatenate([[0.0], np.cumsum(counts)])
    s = np.concatenate([[0.0], np.cumsum(counts * lengths)])
    # pad[i, j]: padding if lengths i..j-1 share a bucket of length lengths[j-1]
    pad = np.full((n + 1, n + 1), np.inf)
    for j in range(1, n + 1):
        pad[:j, j] = lengths[j - 1] * (c[j] - c[:j]) - (s[j] - s[:j])
    best = np.full(n + 1, np.inf)
    best[0] = 0.0
    back = []
    for _ in range(min(n_buckets, n)):
        total = best[:, None] + pad
        back.append(total.argmin(axis=0))
        best = total[back[-1], np.arange(n + 1)]
    out, j = [], n
    for b in reversed(back):
        out.append(int(lengths[j - 1]))
        j = int(b[j])
        if j == 0:
            break
    return out[::-1]


def pack(
    docs: DataFrame,
    length: Column | None = None,
    max_len: int = 2_048,
    n_buckets: int = 16,
    token_budget: int = 32_768,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """One row per segment: its span in the document, bucket length, batch and place in the batch. Batches are numbered from 0
    in each bucket; all but the last of a bucket are full."""
    tokens = word_length(docs["text"]) if length is None else length
    slim = docs.select(
        "doc_id", F.xxhash64("text").alias("key"), F.coalesce(tokens.cast("bigint"), F.lit(0).cast("bigint")).alias("n")
    )
    units = slim.groupBy("doc_id", "key", "n").agg(F.count("*").alias("copies"))
    last = F.greatest(F.ceil(F.col("n") / max_len) - 1, F.lit(0))
    segments = units.select("doc_id", "key", "n", "copies", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("segment"))
    segments = durable(
        segments.select(
            "doc_id",
            "copies",
            "segment",
            (F.col("segment") * max_len).alias("start"),
            F.least(F.col("n") - F.col("segment") * max_len, F.lit(max_len)).alias("n_tokens"),
            F.xxhash64("doc_id", "key", "segment").alias("shuffled"),
        )
    )
    histogram = {r["n_tokens"]: r["c"] for r in segments.groupBy("n_tokens").agg(F.sum("copies").alias("c")).collect()}
    boundaries = optimal_boundaries(histogram, n_buckets)
    bucket = F.lit(None).cast("bigint")
    for b in reversed(boundaries):
        bucket = F.when(F.col("n_tokens") <= b, F.lit(b).cast("bigint")).otherwise(bucket)
    parts = max(1, math.ceil(sum(histogram.values()) / part_rows))
    placed = segments.withColumns({"bucket_len": bucket, "part": F.pmod("shuffled", F.lit(parts))})
    before = W.partitionBy("bucket_len").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    sizes = placed.groupBy("bucket_len", "part").agg(F.sum("copies").alias("size"))  # a row per part
    sizes = sizes.select("bucket_len", "part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("earlier"))
    inside = (
        W.partitionBy("bucket_len", "part").orderBy("shuffled", "doc_id", "segment", "n_tokens").rowsBetween(W.unboundedPreceding, -1)
    )
    ranked = placed.withColumn("above", F.coalesce(F.sum("copies").over(inside), F.lit(0))).join(sizes, ["bucket_len", "part"])
    rows = ranked.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)).alias("copy"))
    rank = F.col("earlier") + F.col("above") + F.col("copy")
    per_batch = F.greatest(F.lit(1).cast("bigint"), F.expr(f"{token_budget} div greatest(bucket_len, 1)"))
    return rows.select(
        "doc_id",
        "segment",
        F.col("start").alias("start_token"),
        "n_tokens",
        "bucket_len",
        (F.col("bucket_len") - F.col("n_tokens")).alias("padding"),
        F.floor(rank / per_batch).alias("batch"),
        (rank % per_batch).alias("place"),
    )
