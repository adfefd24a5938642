"""Quality rules whose cutoffs are certified on labelled holdouts.

Each rule rejects a document whose measure is above a cutoff; all rules of a stratum move together on one ladder. Step k puts every
rule's cutoff where a given share of the stratum's documents lies above it, from lenient to strict. These quantiles are taken over all
documents but the labelled ones that the test below uses, so the ladder does not know them. A step is certified if, among the labelled
good documents of the stratum, so few would be rejected by any rule that a true rejection rate above `risk` is refuted by the exact
binomial test at the stratum's level; the walk ends at the first step that fails (fixed-sequence testing needs no further
correction), and the strictest certified step is used. Levels are corrected over strata by Holm's rule in its sequential form: every
stratum starts with `delta / strata`, and one that is certified to the end of its ladder hands its level on to the others. Together:
with probability 1 - delta no stratum loses more than the share `risk` of its good documents to the rules. A stratum with too few
labels for any certificate has no cutoffs and takes no part in the correction: the base rule alone decides there.

Defined results: null texts have no words and fail the base rule. A null stratum counts as the empty one.
Labels of one document that disagree, and null ones, are not used. Without labels no rule is certified and the base rule
alone decides. Repeated rows give repeated results. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwright.llm.common import per_batch, space_words, texts_of, written

#: Fixed value: the characters counted as symbols.
SYMBOLS = b"#*$%&|<>"
_NOT_SYMBOLS = bytes(c for c in range(256) if c not in SYMBOLS)
_SPACE_OR_TAIL = bytes([0x20, *range(0x09, 0x0E), *range(0x80, 0xC0)])  # white space, and bytes after the first of a character
_UPPER = bytes(range(0x41, 0x5B))
_LETTERS = _UPPER + bytes(range(0x61, 0x7B))
_NOT_LETTERS = bytes(c for c in range(256) if c not in _LETTERS)
_NOT_UPPER = bytes(c for c in range(256) if c not in _UPPER)

MEASURES = ("symbol_share", "dup_line_share", "repeat_share", "upper_share", "bang_share", "same_word_share")
#: The steps of the ladder: shares of documents above a rule's cutoff, from lenient to strict, by a quarter more each.
LADDER = tuple(round(0.0005 * 1.25**k, 6) for k in range(28))
#: Above every measure: rejects nothing.
NO_CUTOFF = 9.0

_MEASURED = pa.struct(
    [(n, pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [(m, pa.float64()) for m in MEASURES]
)


def repeated_words(words: list[bytes], size: int = 5) -> int:
    """Words inside windows of `size` words that occur at least twice in the text."""
    windows = list(zip(*(words[k:] for k in range(size))))
    seen = Counter(windows)
    if len(seen) == len(windows):
        return 0
    n = stop = 0
    for at, w in enumerate(windows):
        if seen[w] > 1:
            n += at + size - max(at, stop)
            stop = at + size
    return n


def measure(text: bytes) -> dict:
    words = space_words(text)
    lines = [x for x in text.split(b"\n") if x.strip()]
    chars = len(text.translate(None, _SPACE_OR_TAIL))
    symbols = len(text.translate(None, _NOT_SYMBOLS))
    dup_lines = len(lines) - len(set(lines))
    repeats = repeated_words(words)
    letters = len(text.translate(None, _NOT_LETTERS))
    return {
        "n_words": len(words),
        "word_chars": chars,
        "n_symbols": symbols,
        "n_dup_lines": dup_lines,
        "n_repeat_words": repeats,
        "symbol_share": symbols / max(1, chars),
        "dup_line_share": dup_lines / max(1, len(lines)),
        "repeat_share": repeats / max(1, len(words)),
        "upper_share": len(text.translate(None, _NOT_UPPER)) / max(1, letters),
        "bang_share": text.count(b"!") / max(1, chars),
        # Zipf's law makes long texts repeat words anyway: the square root takes the length out.
        "same_word_share": 1.0 - min(1.0, len(set(words)) / (2.0 * math.sqrt(max(1, len(words))))),
    }


def _measure(text: pa.Array) -> pa.Array:
    return pa.array([measure(t) for t in texts_of(text)], _MEASURED)


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial, summed exactly in logarithms."""
    if k >= n:
        return 1.0
    terms = [
        math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
        for i in range(k + 1)
    ]
    top = max(terms)
    return min(1.0, math.exp(top) * math.fsum(math.exp(t - top) for t in terms))


def strictest(rejected: list[int], n: int, rate: float, level: float) -> int | None:
    """The last step of the ladder reached by certified steps; rejected: good documents that each step rejects."""
    best = None
    for step, k in enumerate(rejected):
        if k > rate * n or binomial_tail(k, n, rate) > level:
            break
        best = step
    return best


def certified_steps(rejected: dict[str, list[int]], n: dict[str, int], risk: float, delta: float) -> dict[str, int | None]:
    """The step of every stratum that takes part; rejected and n: labelled good documents, rejected by step and all."""
    by_size = sorted(n, key=lambda s: (-n[s], s))
    able = lambda k: n[by_size[k - 1]] >= math.log(k / delta) / -math.log1p(-risk)
    taking = by_size[: max((k for k in range(1, len(by_size) + 1) if able(k)), default=0)]
    level = {s: delta / len(taking) for s in taking}
    done: set[str] = set()
    while True:
        steps = {s: strictest(rejected[s], n[s], risk, level[s]) for s in taking}
        ended = [s for s in taking if s not in done and steps[s] == len(rejected[s]) - 1]
        left = [s for s in taking if s not in done and s not in ended]
        if not ended or not left:
            return steps
        for s in left:
            level[s] += sum(level[e] for e in ended) / len(left)
        done |= set(ended)


def certified_cutoffs(good: DataFrame, others: DataFrame, risk: float, delta: float) -> list[tuple[str, list[float]]]:
    """(stratum, cutoff of every measure) of the strata with enough labels. good: stratum and measures of labelled good documents;
    others: those of the documents that the ladder may know."""
    least = math.log(1 / delta) / -math.log1p(-risk)  # fewer labels certify nothing
    counts = good.groupBy("stratum").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    n = {r["stratum"]: r["n"] for r in counts.collect()}  # at most one row per `least` labels
    if not n:
        return []
    shares = F.array(*[F.lit(1 - x) for x in LADDER])
    strata = good.sparkSession.createDataFrame([(s,) for s in n], "stratum string")
    ladders = others.join(F.broadcast(strata), "stratum").groupBy("stratum")
    ladders = ladders.agg(*[F.percentile_approx(m, shares, 10_000).alias(f"ladder_{m}") for m in MEASURES])
    ladder = {r["stratum"]: [r[f"ladder_{m}"] for m in MEASURES] for r in ladders.collect()}
    known = good.sparkSession.createDataFrame(
        [(s, *cuts) for s, cuts in ladder.items()], "stratum string, " + ", ".join(f"ladder_{m} array<double>" for m in MEASURES)
    )
    # The first step that rejects the document: cutoffs only fall from step to step.
    lenient = lambda m: F.size(F.filter(f"ladder_{m}", lambda c: c >= F.col(m)))
    steps = [lenient(m) for m in MEASURES]
    first = good.join(F.broadcast(known), "stratum").select("stratum", F.least(*steps).alias("step"))
    rejected = {s: [0] * len(LADDER) for s in ladder}
    for r in first.groupBy("stratum", "step").agg(F.count("*").alias("n")).collect():
        for k in range(r["step"], len(LADDER)):
            rejected[r["stratum"]][k] += r["n"]
    found = certified_steps(rejected, {s: n[s] for s in ladder}, risk, delta)
    return [(s, [cuts[k] for cuts in ladder[s]]) for s, k in found.items() if k is not None]


def measured(docs: DataFrame, stratum: Column) -> DataFrame:
    """Base counts and measures per document, kept as a table: the cutoffs and the verdicts both read it."""
    rows = docs.select("doc_id", F.coalesce(stratum.cast("string"), F.lit("")).alias("stratum"), per_batch(_measure, _MEASURED)(docs["text"]).alias("m"))
    return written(rows.select("doc_id", "stratum", "m.*"), "quality-measures")


def base_failed() -> Column:
    n = F.col("n_words")
    return (n < 10) | (F.col("n_repeat_words") * 100 > n * 20)


def apply_rules(docs: DataFrame, labels: DataFrame, risk: float = 0.05, delta: float = 0.05, stratum: str = "lang") -> DataFrame:
    """One row per document: base counts, the base rule, and whether it is kept. Cutoffs are learned from labels with
    crc32(doc_id) mod 5 not 0; the rest stays unseen for checks."""
    spark = docs.sparkSession
    rows = measured(docs, docs[stratum])
    agreed = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("least"))
        .where((F.col("least") == 1) & (F.crc32(F.col("doc_id").cast("string")) % 5 != 0))
        .select("doc_id")
    )
    passed = rows.where(~base_failed())
    good = passed.join(agreed, "doc_id", "left_semi").select("stratum", *MEASURES)
    others = passed.join(agreed, "doc_id", "left_anti").select("stratum", *MEASURES)
    limits = spark.createDataFrame(
        [(s, *cuts) for s, cuts in certified_cutoffs(good, others, risk, delta)],
        "stratum string, " + ", ".join(f"limit_{m} double" for m in MEASURES),
    )
    judged = rows.join(F.broadcast(limits), "stratum", "left")  # a row per certified stratum
    rejected = F.lit(False)
    for m in MEASURES:
        rejected |= F.col(m) > F.coalesce(f"limit_{m}", F.lit(NO_CUTOFF))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed().alias("base_failed"),
        (~base_failed() & ~rejected).alias("kept"),
        "stratum",
        *MEASURES,
    )
