"""Mixing sources to target weights by entropy balancing.

Every document of a source gets a rate w between 0 and `most` (3): how often the mix takes it. Among all rates that meet the source's
target in tokens, the ones chosen minimise the entropy sum(w log w - w) against taking each document once. The dual of that
convex problem has one variable per source, and its solution tilts the rates exponentially by a document's tokens:
w = min(most, exp(lambda * tokens / mean tokens)). A source above its target thus gives up long documents first, one below it
repeats long documents first; short ones stay near one copy. Newton's method finds all lambdas at once: each round is one
distributed aggregation of the gradient and the curvature over the documents, which are counted beforehand by (source, tokens),
the only things a rate depends on. A bracket known in closed form catches steps that go astray.

Rates become whole copies by systematic rounding: within a source, documents stand in the order of their tokens, and a
document gets as many copies as whole numbers lie in its stretch of the running sum of rates. The tokens taken miss the sum of
rate * tokens by less than the tokens of the source's longest document.

Targets: sources in code-point order, null last, weigh 1, 2, 3, 1, 2, ... and share all tokens; a target above `most` times its source's
tokens stops there and the rest is shared out again by weight.

Defined results: null, empty and blank texts have size 0 and take nothing. A null source is a source of its own. A source without
tokens has target 0. Rows equal in id, source and size are interchangeable; they are counted together and dealt out at the end.
Null ids are allowed. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barwright.llm.common import durable, fresh, named, written
from barwright.llm.packing import word_length

#: Most copies of a document, and the weights that sources get in turn.
MOST, WEIGHTS = 3, (1, 2, 3)
#: Relative gap to a target at which Newton's method stops, and its most rounds.
CLOSE, ROUNDS = 1e-9, 80
#: Documents that are numbered together, and equal rows that are written together.
BLOCK, RUN = 65_536, 16_384


def _source_key(source: Column) -> Column:
    """Orders like the source by code point, null last; never null."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("t"))


def _numbered(frame: DataFrame, key: str) -> DataFrame:
    """frame (keys distinct) with `number`: the place of its key in the order of keys, from 0. Ranges of keys are numbered apart."""
    ranges = durable(frame.repartitionByRange(key).withColumn("range", F.spark_partition_id()))
    before = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)  # a row per range
    starts = ranges.groupBy("range").agg(F.count("*").alias("n"))
    starts = starts.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = W.partitionBy("range").orderBy(key)
    return ranges.join(F.broadcast(starts), "range").select(
        *frame.columns, (F.col("start") + F.row_number().over(inside) - 1).alias("number")
    )


def targets(sources: DataFrame, most: int = MOST, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """sources (source, tokens, ...) with `target`. What stops at the limit leaves its excess to the others, again and again."""
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("number") % len(weights)).cast("int") + 1)
    state = durable(_numbered(sources, "source").select(*sources.columns, weight.alias("weight"), F.lit(False).alias("full")))
    limit = most * F.col("tokens")
    total = state.agg(F.sum("tokens")).first()[0] or 0
    while True:
        sums = state.agg(
            F.sum(F.when(F.col("full"), limit)).alias("given"), F.sum(F.when(~F.col("full"), F.col("weight"))).alias("w")
        ).first()
        level = (total - (sums["given"] or 0)) / sums["w"] if sums["w"] else 0.0
        share = F.col("weight") * F.lit(level)
        over = ~F.col("full") & (share > limit)
        if state.where(over).isEmpty():
            target = F.when(F.col("full"), limit.cast("double")).otherwise(share)
            return state.select(*sources.columns, target.alias("target"))
        state = durable(state.withColumn("full", F.col("full") | over))


def _rate(most: int) -> Column:
    return F.least(F.lit(float(most)), F.exp(F.least(F.col("lam") * F.col("size") / F.col("mean"), F.lit(50.0))))


def _exact_sum(value: Column) -> Column:
    """A sum in multiples of 2^-32: the same in whatever order the rows come, so that reruns agree."""
    return F.sum((value * float(1 << 32)).cast("decimal(38,0)")).cast("double") / float(1 << 32)


def balanced(classes: DataFrame, wanted: DataFrame, most: int = MOST) -> DataFrame:
    """wanted (source, tokens, documents, target) with `lam`, from classes (source, size, n) of documents."""
    filled = F.coalesce(F.try_divide("target", "tokens"), F.lit(0.0))
    top = F.col("mean") * math.log(most)  # at this lambda documents of one token are taken `most` times, and all longer ones
    state = wanted.withColumn("mean", F.greatest(F.lit(1.0), F.col("tokens")) / F.col("documents")).withColumns(
        {
            "lo": F.when(filled < 1, F.col("mean") * F.log(filled)).otherwise(0.0),
            "hi": F.when(filled < 1, F.lit(0.0)).otherwise(top),
        }
    )
    settled = (F.col("tokens") == 0) | (F.col("target") <= 0) | (filled >= most * (1 - CLOSE))
    start = F.when(F.col("tokens") == 0, 0.0).when(filled >= most * (1 - CLOSE), top).otherwise(0.0)
    state = durable(state.withColumns({"lam": start, "done": settled}))
    for _ in range(ROUNDS):
        if state.where("not done").isEmpty():
            break
        weighed = classes.join(state.where("not done").select("source", "lam", "mean"), "source")
        mass = F.col("n") * _rate(most) * F.col("size")
        bent = F.when(_rate(most) < most, mass * F.col("size") / F.col("mean")).otherwise(0.0)
        sums = weighed.groupBy("source").agg(_exact_sum(mass).alias("gained"), _exact_sum(bent).alias("curve"))
        gap = F.col("gained") - F.col("target")
        newton = F.col("lam") - F.try_divide(gap, F.col("curve"))
        low = F.when(gap < 0, F.col("lam")).otherwise(F.col("lo"))
        high = F.when(gap > 0, F.col("lam")).otherwise(F.col("hi"))
        step = F.when((F.col("curve") > 0) & (newton > low) & (newton < high), newton).otherwise((low + high) / 2)
        near = F.abs(gap) <= CLOSE * F.col("target")
        moved = F.col("gained").isNotNull() & ~F.col("done")
        state = durable(
            state.join(sums, "source", "left").select(
                *wanted.columns,
                "mean",
                F.when(moved, low).otherwise(F.col("lo")).alias("lo"),
                F.when(moved, high).otherwise(F.col("hi")).alias("hi"),
                F.when(moved & ~near, step).otherwise(F.col("lam")).alias("lam"),
                (F.col("done") | F.coalesce(near, F.lit(False))).alias("done"),
            )
        )
    return state.select(*wanted.columns, "mean", "lam")


def _units(docs: DataFrame, id_column: str, text: str, source: str, size: Column | None, most: int, weights: tuple[int, ...]) -> DataFrame:
    """Documents counted by id, source and size (m rows each), with the copies that the first `extra` of them (base + 1) and the others
    (base) get."""
    length = word_length(named(docs, text)) if size is None else size
    slim = docs.select(
        named(docs, id_column).alias("doc_id"),
        _source_key(named(docs, source)).alias("source"),
        F.coalesce(length.cast("bigint"), F.lit(0).cast("bigint")).alias("size"),
    )
    units = written(slim.groupBy("doc_id", "source", "size").agg(F.count("*").alias("m")), "mixing-units")
    classes = durable(units.groupBy("source", "size").agg(F.sum("m").alias("n")))
    totals = classes.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("tokens"), F.sum("n").alias("documents"))
    state = balanced(classes, durable(targets(totals, most, weights)), most)

    inside = W.partitionBy("source").orderBy("size").rowsBetween(W.unboundedPreceding, -1)  # a row per size of the source
    rated = classes.join(state, "source").withColumn("rate", F.when(F.col("target") <= 0, 0.0).otherwise(_rate(most)))
    rated = rated.withColumn("before", F.coalesce(F.sum(F.col("n") * F.col("rate")).over(inside), F.lit(0.0)))
    rated = durable(
        rated.select("source", "size", "rate", "before", "target", F.col("tokens").alias("source_size"), F.ceil(F.col("n") / BLOCK).alias("blocks"))
    )
    luck = F.xxhash64("doc_id", F.lit("mixing"))
    placed = units.join(rated, ["source", "size"]).withColumns({"luck": luck, "block": F.pmod(luck, F.col("blocks"))})
    ahead = W.partitionBy("source", "size").orderBy("block").rowsBetween(W.unboundedPreceding, -1)  # a row per block
    starts = placed.groupBy("source", "size", "block").agg(F.sum("m").alias("rows"))
    starts = starts.select("source", "size", "block", F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("start"))
    order = W.partitionBy("source", "size", "block").orderBy("luck", "doc_id").rowsBetween(W.unboundedPreceding, -1)
    counted = placed.withColumn("above", F.coalesce(F.sum("m").over(order), F.lit(0))).join(starts, ["source", "size", "block"])
    place = F.col("start") + F.col("above")
    until = lambda rows: F.floor(F.col("before") + rows * F.col("rate") + 0.5)
    total = until(place + F.col("m")) - until(place)
    base = F.floor(total / F.col("m"))
    return counted.select(
        "doc_id",
        F.when(F.col("source") != "t", F.expr("substring(source, 2)")).alias("source"),
        "size",
        "m",
        "source_size",
        "target",
        "rate",
        base.alias("base"),
        (total - base * F.col("m")).alias("extra"),
    )


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    source: str = "source",
    size: Column | None = None,
    most: int = MOST,
    weights: tuple[int, ...] = WEIGHTS,
) -> DataFrame:
    """One row per document: its size, its source's tokens and target, its rate, its copies and the tokens taken. `size` counts a
    document's tokens (default: white-space words)."""
    units = durable(_units(docs, id_column, text, source, size, most, weights))
    columns = ["doc_id", "size", "source_size", "target", "rate"]
    single = units.where("m = 1").select(*columns, (F.col("base") + F.col("extra")).alias("copies"))
    # Equal rows: runs of bounded length, spread over tasks before they are written out.
    kinds = F.explode(
        F.array(
            F.struct(F.col("extra").alias("rows"), (F.col("base") + 1).alias("copies")),
            F.struct((F.col("m") - F.col("extra")).alias("rows"), F.col("base").alias("copies")),
        )
    )
    several = units.where("m > 1").select(*columns, kinds.alias("kind")).select(*columns, "kind.*").where("rows > 0")
    runs = several.select(
        *columns, "copies", "rows", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(rows - 1) div {RUN}"))).alias("run")
    )
    runs = runs.withColumn("length", F.least(F.lit(RUN).cast("bigint"), F.col("rows") - F.col("run") * RUN))
    runs = runs.repartition(F.xxhash64("doc_id", "size", "copies", "run"))
    repeated = runs.select(*columns, "copies", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("length"))).alias("at")).drop("at")
    return single.unionByName(repeated).withColumn("taken", F.col("copies") * F.col("size"))


def mixture(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    source: str = "source",
    size: Column | None = None,
    most: int = MOST,
    weights: tuple[int, ...] = WEIGHTS,
) -> DataFrame:
    """The mix itself: every row of docs as often as it is taken. Of rows equal in id, source and size each takes `base` copies and one
    more with probability extra / m."""
    units = durable(_units(docs, id_column, text, source, size, most, weights))
    length = word_length(named(docs, text)) if size is None else size
    a, b, c, luck, copy = fresh(docs, "__id", "__source", "__size", "__luck", "__copy")
    keyed = docs.withColumns(
        {c: F.coalesce(length.cast("bigint"), F.lit(0).cast("bigint")), luck: F.rand(13)}
    )
    chosen = units.select(F.col("doc_id").alias(a), F.col("source").alias(b), F.col("size").alias("__units_size"), "m", "base", "extra")
    same = (
        named(keyed, id_column).eqNullSafe(chosen[a])
        & named(keyed, source).cast("string").eqNullSafe(chosen[b])
        & (keyed[c] == chosen["__units_size"])
    )
    copies = chosen["base"] + F.when(keyed[luck] * chosen["m"] < chosen["extra"], 1).otherwise(0)
    taken = keyed.join(chosen, same).select(*[named(keyed, x) for x in docs.columns], copies.cast("int").alias(copy)).where(F.col(copy) > 0)
    return taken.select(*[named(taken, x) for x in docs.columns], F.explode(F.sequence(F.lit(1), F.col(copy))).alias(copy)).drop(copy)
