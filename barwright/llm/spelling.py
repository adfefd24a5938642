"""Spelling variants: words one edit apart, found by walking a relational trie, several levels in a round.

The trie of all words is relational: a node is a prefix, an edge leads from it to the node with one more character. A state (word, position,
node) says that the word's first `position` characters lead to the node. A word without an edit is at the node of each of its prefixes.
From there every position of a round's levels is edited at once:

* a replacement joins with the edges of the node: all greater siblings of the word's own character behind which the word's next `ahead`
  characters follow, too; the state goes on behind those;
* a deletion goes past the character without leaving the node; the last of a run of equal characters stands for them all.

Insertions and replacements by smaller characters are the same pairs seen from the other word. What has its edit, from this round or an
earlier one, then walks along its word's own characters to the depth at which the round ends, and stays if the trie has that node. Who
reaches the end of a word there has found a neighbour. The last round walks to the ends of all words.

Near the root every node has dozens of edges and every wrong turn finds followers, so edits in a word's first `head` characters are
looked for from the other end, with the words read backwards, where they come last. Both readings are one trie with two roots and
walk in the same rounds: forwards, words enter at the node of their first `head` characters, backwards `head` characters before their end.

Edits lie above depth `deepest`. Words that share their first `deepest` characters differ behind them, if in one edit, so that both
rests (or one rest and the other one itself) are equal after one deletion: hashes of all single deletions are joined and the pairs
compared in full. So the number of rounds is bounded, however long words are.

A word's form is its neighbour of largest count, if that is at least `ratio` times its own; its root follows forms to the last.

Defined results: null and empty texts have no words. A null id counts as the empty string in the hash that decides deletions.
Repeated rows count again. Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwright.llm.common import durable, named, written

#: Code points of the shortest word, and occurrences of the rarest.
SHORTEST, RAREST = 7, 2
#: How many times more frequent a form is than the word.
RATIO = 10
#: Depth at which edits end, and how many characters at a word's front are looked at from its end.
DEPTH, HEAD = 32, 3
#: Levels of a round, and characters behind a replaced one that its edge has to lead to.
STRIDE, AHEAD = 8, 4
#: Rows of a partition from which a task builds a table that stays in memory; the session's partitions grow in number beyond that.
_BUILT = 200_000
#: One run in so many loses a character.
SLIP = 31
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _part(text: Column, begin: Column | int, length: Column | int) -> Column:
    as_column = lambda x: F.lit(x) if isinstance(x, int) else x
    return F.substring(text, as_column(begin), as_column(length))


def word_counts(docs: DataFrame, id_column: str = "doc_id", text: str = "text", shortest: int = SHORTEST, rarest: int = RAREST) -> DataFrame:
    """(word, n) of the words of all documents, some runs with a character deleted as their hash says."""
    runs = F.regexp_extract_all(named(docs, text), F.lit("[A-Za-z\\u00C0-\\u00FF]{%d,}" % shortest), F.lit(0))
    found = docs.select(F.coalesce(named(docs, id_column).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    found = found.select("id", F.translate("run", _UPPER, _LOWER).alias("run"))
    found = found.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run")))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(_part(F.col("run"), 1, at), F.expr(f"substring(run, cast(h % length(run) as int) + 2)"))
    word = F.when(F.col("h") % SLIP == 0, shorter).otherwise(F.col("run"))
    words = found.select(word.alias("word")).where(F.length("word") >= shortest)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= rarest)


def _read(words: DataFrame, head: int) -> DataFrame:
    """(back, word, enters): every word forwards and backwards, and the depth from which on its edits are looked for."""
    length = F.length("word")
    forwards = words.select(F.lit(False).alias("back"), "word", F.least(length, F.lit(head)).alias("enters"))
    backwards = words.select(F.lit(True).alias("back"), F.reverse("word").alias("word"), F.greatest(length - head, F.lit(0)).alias("enters"))
    return forwards.unionByName(backwards)


def _depths(first: int, until: int) -> tuple[Column, Column]:
    """Where a word's edits of the round begin, and before which depth they end."""
    return F.greatest("enters", F.lit(first)), F.least(F.length("word"), F.lit(until))


def _rounds(read: DataFrame, deepest: int) -> tuple[int | None, list[tuple[int, int, int, int]]]:
    """The length of the longest word, and (first, until, edited places, words of at least `first` characters) of each round."""
    spans = [(first, min(first + STRIDE, deepest)) for first in range(0, deepest, STRIDE)]
    places = [F.sum(F.greatest(F.lit(0), end - begin)) for begin, end in (_depths(*span) for span in spans)]
    long = [F.count_if(F.length("word") >= first) for first, _ in spans]
    longest, *sizes = read.agg(F.max(F.length("word")), *places, *long).first()
    return longest, [(*span, *size) for span, size in zip(spans, zip(sizes[: len(spans)], sizes[len(spans) :]))]


def _dealt(frame: DataFrame, built: int, by: list[str]) -> DataFrame:
    """A join's frame of `built` rows, dealt by the join's columns to more partitions where the session's are too few; the other side
    follows. A table that a join builds in memory cannot be spilled, so its size must not hang on the session's partitions."""
    parts = -(-built // _BUILT)
    return frame.repartition(parts, *by) if parts > int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")) else frame


def _edited(read: DataFrame, first: int, until: int, places: int) -> DataFrame:
    """(back, word, pos, node) after one edit at the depths from `first` to before `until`, at that many places of words."""
    begin, end = _depths(first, until)
    at = read.where(begin < end).select("back", "word", F.explode(F.sequence(begin, end - 1)).alias("pos"))
    word, pos = F.col("word"), F.col("pos")
    exact = at.select(
        "back", "word", "pos", _part(word, 1, pos).alias("node"), _part(word, pos + 1, 1).alias("own"), _part(word, pos + 2, AHEAD).alias("after")
    )
    # Words of equal length are at the same depths, so the edges that a replacement needs are those of the states themselves.
    # They are dealt once, for their distinct rows and for the join; a task's share is hashed, the states are not sorted.
    by = ["back", "node", "after"]
    edges = _dealt(exact.select(*by, F.col("own").alias("label")).repartition(*by), places, by).distinct().hint("shuffle_hash")
    beside = exact.join(edges, by).where("label > own")
    replaced = beside.select("back", "word", (pos + 1 + F.length("after")).alias("pos"), F.concat("node", "label", "after").alias("node"))
    deleted = exact.where(F.col("own") != F.substring("after", 1, 1)).select("back", "word", (pos + 1).alias("pos"), "node")
    return replaced.unionByName(deleted)


def _walked(read: DataFrame, deepest: int, longest: int, rounds: list[tuple[int, int, int, int]]) -> list[DataFrame]:
    """(back, word, near) pairs whose edit lies at or behind the depth at which the word enters, above `deepest`; each pair from one
    of its words. `longest`: length of the longest word."""
    found, carried = [], None
    for first, until, places, words in rounds:
        last = until >= min(deepest, longest)
        states = _edited(read, first, until, places)
        if carried is not None:
            states = states.unionByName(carried)
        word, pos, node = F.col("word"), F.col("pos"), F.col("node")
        reached = read.where(F.length("word") >= first)  # states of this round are at least as deep
        if last:
            nodes = reached.select("back", F.col("word").alias("node"))
            moved = states.select("back", "word", F.concat(node, F.expr("substring(word, pos + 1)")).alias("node"))
        else:
            to = until + AHEAD  # no edge leads further
            nodes = reached.select("back", _part(word, 1, to).alias("node"))
            more = F.lit(to) - F.length(node)
            moved = states.select("back", "word", (pos + more).alias("pos"), F.concat(node, _part(word, pos + 1, more)).alias("node"))
        by = ["back", "node"]
        level = written(moved.join(_dealt(nodes, words, by).hint("shuffle_hash"), by, "left_semi"), f"spelling-{until}")
        ended = level if last else level.where(F.length("node") < to)
        found.append(ended.select("back", "word", node.alias("near")))
        if last:
            break
        carried = level.where(F.length("node") == to).select("back", "word", "pos", "node")
    return found


_BASE = 0x9E3779B97F4A7C15 | 1


def deletion_hashes(rest: str, seed: int) -> np.ndarray:
    """Distinct hashes of the rest itself and of every rest with one character deleted, in linear time: polynomials modulo 2^64."""
    codes = np.frombuffer(rest.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
    size = len(codes)
    back = np.uint64(pow(_BASE, -1, 1 << 64))
    with np.errstate(over="ignore"):
        base = np.full(size, _BASE, np.uint64)
        base[:1] = 1
        powers = np.cumprod(base, dtype=np.uint64)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * powers, dtype=np.uint64)])
        shorter = sums[:size] + (sums[size] - sums[1:]) * back
        salt = np.array([size, size - 1], np.int64).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) ^ np.uint64(seed % (1 << 64))
        return np.unique(np.concatenate([sums[size:] ^ salt[0], shorter ^ salt[1]]))


def _deleted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, seed, rest in zip(*(batch.column(k).to_pylist() for k in range(3))):
            hashes = deletion_hashes(rest, seed)
            yield pa.record_batch([pa.array(hashes.view(np.int64)), pa.array(np.full(len(hashes), name, np.int64))], ["h", "name"])


def one_edit(a: str, b: str) -> bool:
    """Whether the texts differ by exactly one inserted, deleted or replaced character."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    x, y = (np.frombuffer(t.encode("utf-32-le"), np.uint32) for t in (a, b))
    differ = np.flatnonzero(x != y[: len(x)])
    at = int(differ[0]) if len(differ) else len(x)
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.filter(pa.array(map(one_edit, batch.column(0).to_pylist(), batch.column(1).to_pylist()), pa.bool_()))


def _long_pairs(read: DataFrame, deepest: int) -> DataFrame:
    """(back, word, near) pairs that share their first `deepest` characters."""
    node = _part(F.col("word"), 1, deepest)
    long = read.where(F.length("word") >= deepest).select("back", "word", node.alias("node"))
    shared = long.groupBy("back", "node").agg(F.count("*").alias("below")).where("below > 1")
    long = long.join(shared, ["back", "node"]).select(
        "back",
        "word",
        F.xxhash64("back", "node").alias("seed"),
        F.expr(f"substring(word, {deepest} + 1)").alias("rest"),
        F.monotonically_increasing_id().alias("name"),
    )
    long = written(long, "spelling-long")
    hashes = long.select("name", "seed", "rest").mapInArrow(_deleted, "h bigint, name bigint")
    met = hashes.join(hashes.withColumnRenamed("name", "other"), "h").where("name < other").select("name", "other").distinct()
    met = met.join(long.select("name", "back", "word"), "name")
    met = met.join(long.select(F.col("name").alias("other"), "back", F.col("word").alias("near")), ["other", "back"])
    return met.select("word", "near", "back").mapInArrow(_confirmed, "word string, near string, back boolean")


def neighbours(words: DataFrame, deepest: int = DEPTH, head: int = HEAD) -> DataFrame:
    """(word, near) of all words that differ by one inserted, deleted or replaced character, in both directions. words: distinct."""
    read = _read(words, head)
    longest, rounds = _rounds(read, deepest)
    if longest is None:
        return words.select("word", F.col("word").alias("near"))
    parts = _walked(read, deepest, longest, rounds)
    if longest >= deepest:
        parts.append(_long_pairs(read, deepest))
    every = None
    for part in parts:
        every = part if every is None else every.unionByName(part)
    forwards = [F.when(F.col("back"), F.reverse(c)).otherwise(F.col(c)).alias(c) for c in ("word", "near")]
    every = every.select(*forwards)
    both = every.unionByName(every.select(F.col("near").alias("word"), F.col("word").alias("near")))
    return durable(both.distinct())


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form, by jumping along forms: counts grow tenfold at each, so there are few jumps."""
    state = durable(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = state.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = state.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        moved = durable(moved)
        if moved.where("moved").isEmpty():
            return moved.select("word", "root")
        state = moved.select("word", "root")


def variants(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    shortest: int = SHORTEST,
    rarest: int = RAREST,
    ratio: int = RATIO,
    deepest: int = DEPTH,
) -> DataFrame:
    """One row per word: its count, its neighbours' number, its form with count, and the root of its forms."""
    words = written(word_counts(docs, id_column, text, shortest, rarest), "spelling-words")
    near = neighbours(words.select("word"), deepest)
    counted = near.join(words.select(F.col("word").alias("near"), F.col("n").alias("m")), "near")
    best = counted.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "near")).alias("best"))
    formed = -F.col("best.m") >= ratio * F.col("n")
    rated = words.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(formed, F.col("best.near")).alias("form"),
        F.when(formed, -F.col("best.m")).alias("form_n"),
    )
    rated = durable(rated)
    roots = _roots(rated.where("form is not null"))
    return rated.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
