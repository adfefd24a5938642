"""Sharding by sampled splitters, with shards of near equal bytes.

Records are ordered by a hash of their text, so equal texts stand together. Size-weighted samples of the keys give quantile
splitters; a key that alone outweighs a range gets a range of its own. Every record finds its range by the splitters, exact
range sizes follow from one aggregation, and ranges above twice the mean are subdivided, one-key ranges by a hash of the
id. Running sums inside ranges, shifted by the sizes of earlier ranges, give each record its place in the global order; the
shard is the fortieth (1/n) of all bytes in which the middle of its group, or of the record itself if the group is large, lies.

Law: `bytes`. Shard sizes differ from the mean by at most one group of up to `whole_share` of a shard at either edge.

Defined results: null texts have size 16 (`overhead`) and crc 0, and are one group. Rows equal in id, size and checksum are
interchangeable: they are counted together and dealt out at the end. Null ids are allowed. An empty table gives no rows. Extra
columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barwright.llm.common import durable, named

#: Most ranges, and samples taken for each. Both bound what the driver gathers: splitters and samples.
MAX_RANGES, OVERSAMPLE = 16_384, 32
_CELL_BITS = 14


def splitters(samples: list[tuple[int, float]], step: float) -> list[int]:
    """Lowest keys of the ranges but the first, from samples (key, weight) in key order."""
    cuts, filled = set(), 0.0
    for key, weight in samples:
        if weight >= step:
            cuts |= {key, key + 1}
            filled = 0.0
            continue
        filled += weight
        if filled >= step:
            cuts.add(key)
            filled = 0.0
    return sorted(c for c in cuts if c < 1 << 63)


def _ranged(units: DataFrame, cuts: list[int]) -> DataFrame:
    """units with `rng`, the number of cuts at or below its key. Keys are hashes, so equal cells hold about as many cuts each."""
    spark = units.sparkSession
    cell_of = lambda key: (key + (1 << 63)) >> (64 - _CELL_BITS)
    inside: dict[int, list[int]] = {}
    for c in cuts:
        inside.setdefault(cell_of(c), []).append(c)
    rows, below = [], 0
    for cell in range(1 << _CELL_BITS):
        own = inside.get(cell, [])
        rows.append((cell, below, own))
        below += len(own)
    cells = spark.createDataFrame(rows, "cell int, below int, cuts array<bigint>")
    cell = (F.shiftrightunsigned("k1", 64 - _CELL_BITS).cast("int")).bitwiseXOR(F.lit(1 << (_CELL_BITS - 1)))
    joined = units.withColumn("cell", cell).join(F.broadcast(cells), "cell")  # 2^14 rows
    rng = F.col("below") + F.size(F.filter("cuts", lambda c: c <= F.col("k1")))
    return joined.withColumn("rng", rng).drop("cell", "below", "cuts")


def shard(
    docs: DataFrame,
    n_shards: int = 40,
    overhead: int = 16,
    whole_share: float = 0.02,
    range_bytes: int = 128 << 20,
    id_column: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per record: its size, text checksum, shard and slot in the shard."""
    body = named(docs, text)
    raw = docs.select(
        named(docs, id_column).cast("bigint").alias("doc_id"),
        F.xxhash64(body).alias("k1"),
        (F.coalesce(F.octet_length(body), F.lit(0)).cast("bigint") + overhead).alias("size"),
        F.coalesce(F.crc32(body), F.lit(0).cast("bigint")).alias("crc"),
    )
    units = durable(
        raw.groupBy("doc_id", "k1", "size", "crc")
        .agg(F.count("*").alias("copies"))
        .withColumns({"k2": F.xxhash64("doc_id", F.lit("second")), "bytes": F.col("size") * F.col("copies")})
    )
    total = units.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("b")).first()["b"]
    n_ranges = min(MAX_RANGES, max(8 * n_shards, math.ceil(total / range_bytes)))
    step = max(1.0, total / n_ranges)
    per_sample = step / OVERSAMPLE
    # Sampling by a hash of the record: the same rows on every run.
    luck = F.xxhash64("k1", "k2", F.lit("sample")).cast("double") / float(1 << 64) + 0.5
    drawn = units.where(luck * per_sample < F.col("bytes")).groupBy("k1").agg(F.sum(F.greatest("bytes", F.lit(per_sample))).alias("w"))
    samples = [(r["k1"], r["w"]) for r in drawn.orderBy("k1").collect()]
    ranged = _ranged(units, splitters(samples, step))

    spans = ranged.groupBy("rng").agg(F.sum("bytes").alias("b"), F.min("k1").alias("lo"), F.max("k1").alias("hi"))
    spans = spans.withColumn("pieces", F.when(F.col("b") > 2 * step, F.ceil(F.col("b") / step)).otherwise(1))
    position = F.when(F.col("lo") == F.col("hi"), F.col("k2").cast("double") / float(1 << 64) + 0.5).otherwise(
        (F.col("k1").cast("double") - F.col("lo").cast("double")) / (F.col("hi").cast("double") - F.col("lo").cast("double"))
    )
    piece = F.least(F.floor(F.col("pieces") * position), F.col("pieces") - 1).cast("int")
    cut = ranged.join(F.broadcast(spans), "rng").withColumn("piece", piece)  # a row per range
    cut = cut.select("rng", "piece", "doc_id", "k1", "k2", "size", "crc", "copies", "bytes")

    ahead = W.orderBy("rng", "piece").rowsBetween(W.unboundedPreceding, -1)  # over a row per range piece
    starts = cut.groupBy("rng", "piece").agg(F.sum("bytes").alias("b"), F.sum("copies").alias("n"))
    starts = starts.select(
        "rng",
        "piece",
        F.coalesce(F.sum("b").over(ahead), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("rows_before"),
    )
    order = W.partitionBy("rng", "piece").orderBy("k1", "k2", "doc_id", "size", "crc").rowsBetween(W.unboundedPreceding, -1)
    summed = cut.withColumns(
        {
            "bytes_in": F.coalesce(F.sum("bytes").over(order), F.lit(0)),
            "rows_in": F.coalesce(F.sum("copies").over(order), F.lit(0)),
        }
    )
    group = W.partitionBy("rng", "piece", "k1")
    summed = summed.withColumns({"group_bytes": F.sum("bytes").over(group), "group_start": F.min("bytes_in").over(group)})
    rows = summed.join(F.broadcast(starts), ["rng", "piece"]).select(
        "*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)).alias("copy")
    )
    whole = F.col("group_bytes") <= whole_share * total / n_shards
    middle = F.col("bytes_before") + F.when(whole, F.col("group_start") + F.col("group_bytes") / 2).otherwise(
        F.col("bytes_in") + F.col("copy") * F.col("size") + F.col("size") / 2
    )
    placed = rows.select(
        "doc_id",
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        F.least(F.floor(middle * n_shards / float(max(total, 1))), F.lit(n_shards - 1)).cast("int").alias("shard"),
        (F.col("rows_before") + F.col("rows_in") + F.col("copy")).alias("at"),
    )
    placed = durable(placed)
    firsts = placed.groupBy("shard").agg(F.min("at").alias("first"))
    return placed.join(F.broadcast(firsts), "shard").select(  # a row per shard
        "doc_id",
        "size",
        "text_crc32",
        "law",
        "shard",
        (F.col("at") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
