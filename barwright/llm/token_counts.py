"""Token counts by a two-tier lookup on the map side.

The tokenizer never merges across white space, so a text's count is the sum over its white-space-free pieces. A first pass
over all documents lets each task report its most frequent pieces (a bounded summary, no shuffle of pieces); the most
frequent of all get their lengths on the driver and are broadcast as a table of bounded size. In the second pass a piece is
looked up there, else in a cache of the Python worker, else it is encoded, each once per batch. Which pieces the table holds
changes the speed only, never a count.

Defined results: null and empty texts have no bytes and no tokens. Strings of special tokens inside texts are treated as the
library does by default. Repeated rows give repeated results. Extra columns are ignored.
"""

from __future__ import annotations

import os
import uuid
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwright.llm.common import per_batch, space_words, texts_of, worker_cache

#: Pieces in the broadcast table, pieces that a task reports, and pieces that it counts at once.
TABLE, REPORTED, COUNTED = 65_536, 8_192, 262_144
#: Pieces in a worker's cache, and the longest piece that is kept in it.
CACHED, CACHED_BYTES = 400_000, 64
LIMIT = 2_048


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The partition's most frequent pieces; beyond COUNTED kinds the rarer half of them is forgotten."""
    seen: Counter[bytes] = Counter()
    for batch in batches:
        for text in texts_of(batch.column(0)):
            seen.update(space_words(text))
            if len(seen) > COUNTED:
                seen = Counter(dict(seen.most_common(COUNTED // 2)))
    top = [(p, n) for p, n in seen.most_common(REPORTED) if len(p) <= CACHED_BYTES]
    yield pa.record_batch([pa.array([p for p, _ in top], pa.binary()), pa.array([n for _, n in top], pa.int64())], ["piece", "n"])


def _loaded(json: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_str(json)


def _lengths(tokenizer, pieces: list[bytes]) -> list[int]:
    return [len(e.ids) for e in tokenizer.encode_batch([p.decode() for p in pieces], add_special_tokens=False)]


class PieceLengths:
    """Token counts of pieces: a fixed table, a bounded cache, and the tokenizer for what neither has."""

    def __init__(self, tokenizer, table: dict[bytes, int]):
        self.tokenizer, self.table = tokenizer, table
        self.known = dict(table)

    def counts(self, texts: list[bytes]) -> list[int]:
        pieces = [space_words(t) for t in texts]
        if len(self.known) > CACHED + len(self.table):
            self.known = dict(self.table)
        new = set().union(*pieces).difference(self.known) if pieces else set()
        short = [p for p in new if len(p) <= CACHED_BYTES]
        self.known.update(zip(short, _lengths(self.tokenizer, short)))
        long = [p for p in new if len(p) > CACHED_BYTES]
        once = dict(zip(long, _lengths(self.tokenizer, long)))
        if not once:
            return [sum(map(self.known.__getitem__, p)) for p in pieces]
        return [sum(self.known[x] if len(x) <= CACHED_BYTES else once[x] for x in p) for p in pieces]


def token_column(docs: DataFrame, tokenizer_file: str, text: str = "text"):
    """A column of token counts for the text column; runs the counting pass over docs."""
    spark = docs.sparkSession
    with open(tokenizer_file, encoding="utf-8") as file:
        json = file.read()
    frequent = (
        docs.select(text)
        .mapInArrow(_frequent, "piece binary, n bigint")
        .groupBy("piece")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "piece")
        .limit(TABLE)
    )
    pieces = [bytes(r["piece"]) for r in frequent.select("piece").collect()]
    table = dict(zip(pieces, _lengths(_loaded(json), pieces)))
    sent = spark.sparkContext.broadcast((json, table))
    name = f"pieces-{uuid.uuid4().hex}"

    def count(column: pa.Array) -> pa.Array:
        lengths = worker_cache(name, lambda: PieceLengths(_loaded(sent.value[0]), sent.value[1]), most=1)
        texts, out = texts_of(column), []
        for i in range(0, len(texts), 256):
            out += lengths.counts(texts[i : i + 256])
        return pa.array(out, pa.int64())

    return per_batch(count, pa.int64())(docs[text])


def token_counts(docs: DataFrame, tokenizer_file: str, limit: int = LIMIT) -> DataFrame:
    """One row per document: bytes, tokens and whether it has more tokens than the limit."""
    counted = docs.select(
        "doc_id",
        F.coalesce(F.octet_length("text").cast("bigint"), F.lit(0).cast("bigint")).alias("n_bytes"),
        token_column(docs, tokenizer_file).alias("n_tokens"),
    )
    return counted.select("*", (F.col("n_tokens") > limit).alias("over_limit"))
