"""Language-model scoring by masked pseudo-likelihood.

Tokens are all words and sign runs of the corpus, counted exactly over all documents. The most frequent have codes of their own; the
others share hashed codes, and each has its share of the code's count: log P(token) = log P(code) + log(count / count of code).
Counts of the `_KNOWN` most frequent tokens go to the workers, those of rarer ones are joined. Every document is encoded once, two bytes
a token, in the shared folder; training rounds and the scoring pass read that and no text. A network sees the two tokens on either side of a place and predicts the token there: one table of vectors per
offset, summed to a hidden layer, then the token's code in two steps (its group of 32, and its place in the group given the group),
each a softmax of 32. In training every place of every document is masked once: a round takes a part of them, drawn by a hash; tasks train on
their own documents from common weights, which start at the codes' shares of the corpus, and the weights are averaged by the
number of places, once per round. A document's score
is the sum over all its places of log P(code of the token | both sides) in `log_prob`, and of log P(token | both sides) in
`token_log_prob`.

Defined results: null and empty texts have no tokens, log_prob and token_log_prob 0 and no mean. Repeated rows give repeated results. An empty table
gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwright.llm.common import per_batch, texts_of, worker_cache, written

SIDE = 32
#: Codes, of which HASHED are shared by rarer words; one more code stands for places outside a text.
CODES, HASHED, HIDDEN = SIDE * SIDE, 256, 24
OFFSETS = (-2, -1, 1, 2)
#: Share of the places masked, and learning rate, of each round. The shares are of different places and make up all of them.
ROUNDS = ((0.10, 0.08), (0.45, 0.05), (0.45, 0.05))
_KEPT, _COUNTED, _BATCH, _BLOCK = 200_000, 100_000, 8_192, 4_096
#: Tokens that a worker trains on, or scores, at a time; more where one document has more.
_AT_ONCE = 400_000
#: exp() of numbers up to this size, and sums of them, need no scaling in single precision.
_SAFE = 60
#: So many of the most frequent tokens are numbered, with their counts, in every worker. Logarithms are added up in units of 1 / _UNIT.
_KNOWN, _UNIT = 100_000, 1e9
#: So many draws tell which round masks a place.
_DRAWS = 10_007
_SIGNS = bytes(c for c in range(0x21, 0x7F) if not bytes([c]).isalnum())
_OTHERS = bytes(c for c in range(256) if c not in _SIGNS)
_SHAPES = {
    "table": (len(OFFSETS), CODES + 1, HIDDEN),
    "bias": (HIDDEN,),
    "out": (HIDDEN, 2 * SIDE),
    "shift": (2 * SIDE,),
    "given": (SIDE, SIDE),
}
_LANES = 32
#: Sums of both softmaxes as a product.
_HALVES = np.repeat(np.eye(2, dtype=np.float32), SIDE, axis=0)


def parts_of(piece: bytes) -> tuple[bytes, bytes]:
    """The word of a white-space-free piece, and its signs."""
    word = piece.translate(None, _SIGNS)
    return word, b"" if len(word) == len(piece) else piece.translate(None, _OTHERS)


def bucket(token: bytes) -> int:
    """The hashed code of a token without a code of its own, from 0."""
    return xxhash.xxh3_64_intdigest(token) % HASHED


class Vocabulary:
    """The most frequent tokens with their counts, and the count of every code over all tokens."""

    def __init__(self, words: list[bytes], counts: list[int], of_buckets: np.ndarray):
        """of_buckets: counts of all tokens by bucket, also of those with codes of their own."""
        own = CODES - HASHED
        of_code = np.zeros(CODES)
        of_code[: len(words[:own])] = counts[:own]
        of_code[own:] = of_buckets
        for word, n in zip(words[:own], counts):
            of_code[own + bucket(word)] -= n
        self.words, self.of_code = words, of_code
        self.share = (of_code + 0.5) / (of_code + 0.5).sum()
        #: By number: the token's code, and log(count / count of code). Numbers after those of the words are for rarer tokens of a
        #: bucket, whose own log(count) is missing here.
        self.code = np.array([k if k < own else own + bucket(w) for k, w in enumerate(words)] + list(range(own, CODES)))
        whole = np.log(np.maximum(of_code, 1))[self.code]
        self.weight = np.concatenate([np.log(counts), np.zeros(HASHED)]) - whole


class _Numbers(dict):
    """Piece -> number of its word + 1 and number of its signs + 1 (0: none), packed in one integer."""

    def __init__(self, words: list[bytes]):
        super().__init__()
        self.words = {w: k for k, w in enumerate(words)}

    def number(self, token: bytes) -> int:
        if not token:
            return 0
        known = self.words.get(token)
        return (len(self.words) + bucket(token) if known is None else known) + 1

    def __missing__(self, piece: bytes) -> int:
        if len(self) > _KEPT:
            self.clear()
        word, signs = parts_of(piece)
        value = self[piece] = self.number(word) << 32 | self.number(signs)
        return value


def tokens(pieces: list[bytes], numbers: _Numbers) -> tuple[np.ndarray, list[bytes]]:
    """Numbers of the tokens of a text's pieces, and the tokens that are not among the known ones."""
    packed = np.fromiter(map(numbers.__getitem__, pieces), np.int64, len(pieces))
    both = np.column_stack([packed >> 32, packed & 0xFFFFFFFF])
    strange = np.flatnonzero((both > len(numbers.words)).any(axis=1))
    rare = [t for k in strange.tolist() for t in parts_of(pieces[k]) if t and t not in numbers.words]
    both = both.ravel()
    return both[both > 0] - 1, rare


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(seen: Counter) -> pa.RecordBatch:
        total: Counter[bytes] = Counter()
        for piece, n in seen.items():
            for token in parts_of(piece):
                if token:
                    total[token] += n
        buckets = pa.array([bucket(t) for t in total], pa.int32())
        return pa.record_batch(
            [pa.array(list(total), pa.binary()), buckets, pa.array(list(total.values()), pa.int64())], ["token", "bucket", "n"]
        )

    seen: Counter[bytes] = Counter()
    for batch in batches:
        for text in texts_of(batch.column(0)):
            seen.update(text.lower().split())
            if len(seen) > _COUNTED:
                yield out(seen)
                seen = Counter()
    yield out(seen)


def vocabulary(docs: DataFrame, text: str = "text") -> tuple[Vocabulary, DataFrame]:
    """The vocabulary, and the table of all tokens with their counts."""
    counted = docs.select(text).mapInArrow(_counts, "token binary, bucket int, n bigint")
    counted = written(counted.groupBy("token", "bucket").agg(F.sum("n").alias("n")), "lm-counts")
    top = counted.orderBy(F.desc("n"), "token").limit(_KNOWN).select("token", "n").collect()
    of_buckets = np.zeros(HASHED)
    for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        of_buckets[r["bucket"]] = r["n"]
    return Vocabulary([bytes(r["token"]) for r in top], [r["n"] for r in top], of_buckets), counted


class Model:
    def __init__(self, weights: np.ndarray | None = None, share: np.ndarray | None = None, seed: int = 5):
        """Without weights: random small ones, and outputs that give every code its share of the corpus."""
        if weights is None:
            rng = np.random.default_rng(seed)
            each = (np.full(CODES, 1 / CODES) if share is None else share).reshape(SIDE, SIDE)
            groups = each.sum(axis=1)
            start = {
                "table": rng.normal(0, 0.2, _SHAPES["table"]),
                "bias": np.full(HIDDEN, 0.1),
                "out": rng.normal(0, 0.05, _SHAPES["out"]),
                "shift": np.concatenate([np.log(groups), np.zeros(SIDE)]),
                "given": np.log(each / groups[:, None]),
            }
            weights = np.concatenate([start[n].ravel() for n in _SHAPES])
        self.flat = weights.astype(np.float32)
        self.parts, at = {}, 0
        for name, shape in _SHAPES.items():
            size = int(np.prod(shape))
            self.parts[name] = self.flat[at : at + size].reshape(shape)
            at += size

    def _forward(self, context: np.ndarray, target: np.ndarray):
        p = self.parts
        hidden = p["bias"] + p["table"][0][context[0]]
        for k in range(1, len(OFFSETS)):
            hidden += p["table"][k][context[k]]
        np.maximum(hidden, 0, out=hidden)
        logits = hidden @ p["out"] + p["shift"]
        group, place = target // SIDE, target % SIDE
        logits[:, SIDE:] += p["given"][group]
        logits = logits.reshape(-1, 2, SIDE)
        logits -= logits.max(axis=2, keepdims=True)
        at = np.arange(len(target))
        chosen = logits[at, 0, group] + logits[at, 1, place]
        np.exp(logits, out=logits)
        sums = logits.sum(axis=2)
        return hidden, logits, sums, chosen - np.log(sums).sum(axis=1), group, place, at

    def log_probs(self, stream: np.ndarray, at: np.ndarray) -> np.ndarray:
        """log P(token | both sides) at the places `at` of a stream whose texts have the outside code between them.

        What _forward gives, with the denominators of both softmaxes as one product of matrices: the second one, given the group,
        is a sum of exp(logit) times exp(given)."""
        p, out = self.parts, np.empty(len(at), np.float32)
        first = p["table"][0] + p["bias"]
        given = p["given"] - p["given"].max(axis=1, keepdims=True)
        joint = np.zeros((2 * SIDE, SIDE + 1), np.float32)
        joint[SIDE:, :SIDE], joint[:SIDE, SIDE] = np.exp(given).T, 1
        given = given.ravel()
        for start in range(0, len(at), _BLOCK):
            a = at[start : start + _BLOCK]
            target, rows = stream[a], np.arange(len(a))
            hidden = first.take(stream[a + OFFSETS[0]], axis=0)
            for k in range(1, len(OFFSETS)):
                hidden += p["table"][k].take(stream[a + OFFSETS[k]], axis=0)
            np.maximum(hidden, 0, out=hidden)
            logits = hidden @ p["out"]
            logits += p["shift"]
            if max(logits.max(), -logits.min()) > _SAFE:
                halves = logits.reshape(-1, 2, SIDE)
                halves -= halves.max(axis=2, keepdims=True)
            group = target // SIDE
            chosen = logits[rows, group] + logits[rows, SIDE + target % SIDE] + given[target]
            np.exp(logits, out=logits)
            sums = logits @ joint
            out[start : start + _BLOCK] = chosen - np.log(sums[:, SIDE]) - np.log(sums[rows, group])
        return out

    def step(self, stream: np.ndarray, at: np.ndarray, squares: np.ndarray, rate: float) -> None:
        """One Adagrad step on the places `at`."""
        p, n = self.parts, len(at)
        rows, target = np.arange(n), stream[at]
        group, place = np.divmod(target, SIDE)
        hidden = p["table"][0].take(stream[at + OFFSETS[0]], axis=0)
        for k in range(1, len(OFFSETS)):
            hidden += p["table"][k].take(stream[at + OFFSETS[k]], axis=0)
        hidden += p["bias"]
        np.maximum(hidden, 0, out=hidden)
        delta = hidden @ p["out"]
        delta += p["shift"]
        delta[:, SIDE:] += p["given"].take(group, axis=0)
        halves = delta.reshape(n, 2, SIDE)
        if max(delta.max(), -delta.min()) > _SAFE:
            halves -= halves.max(axis=2, keepdims=True)
        np.exp(delta, out=delta)
        halves /= (delta @ _HALVES)[:, :, None]
        delta[rows, group] -= 1
        delta[rows, SIDE + place] -= 1
        delta /= n
        of_group = np.zeros((n, SIDE), np.float32)
        of_group[rows, group] = 1
        back = delta @ p["out"].T
        back *= hidden > 0
        table = np.zeros(_SHAPES["table"], np.float32)
        for k, offset in enumerate(OFFSETS):  # sums by code
            code = stream[at + offset].astype(np.int16)
            order = np.argsort(code, kind="stable")
            code = code[order]
            heads = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
            table[k][code[heads]] = np.add.reduceat(back.take(order, axis=0), heads, axis=0)
        ones = np.ones(n, np.float32)
        ends = ones @ back, (hidden.T @ delta).ravel(), ones @ delta, (of_group.T @ delta[:, SIDE:]).ravel()
        grad = np.concatenate([table.ravel(), *ends])
        squares += grad * grad
        np.divide(grad, np.sqrt(squares) + 1e-6, out=grad, casting="same_kind")
        self.flat -= np.float32(rate) * grad


def joined_stream(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All tokens with two outside codes around each text, and the places of the tokens."""
    gap = np.full(2, CODES)
    stream = np.concatenate([gap, *[x for t in texts for x in (t, gap)]])
    return stream, np.flatnonzero(stream < CODES)


_ENCODED = pa.struct([("n_tokens", pa.int64()), ("own", pa.float64()), ("codes", pa.binary()), ("rare", pa.list_(pa.binary()))])


def encoded(docs: DataFrame, vocab: Vocabulary, text: str = "text") -> DataFrame:
    """(row, doc_id, n_tokens, own, codes, rare), written once: a number of the row, the codes of the document's tokens as 16-bit integers,
    the sum of log(count / count of code) over the known tokens and of -log(count of code) over the others, and the others."""
    name, sent = f"lm-words-{uuid.uuid4().hex}", docs.sparkSession.sparkContext.broadcast(vocab)

    def column(batch: pa.Array) -> pa.Array:
        known, numbers = worker_cache(name, lambda: (sent.value, _Numbers(sent.value.words)))
        counts, owns, codes, rare = [], [], [], []
        for value in texts_of(batch):
            ids, others = tokens(value.lower().split(), numbers)
            counts.append(len(ids))
            owns.append(float(known.weight[ids].sum()))
            codes.append(known.code[ids].astype("<i2").tobytes())
            rare.append(others)
        return pa.StructArray.from_arrays(
            [pa.array(x, f.type) for x, f in zip((counts, owns, codes, rare), _ENCODED)], fields=list(_ENCODED)
        )

    texts = docs.select("doc_id", per_batch(column, _ENCODED)(docs[text]).alias("s"))
    return written(texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", "s.*"), "lm-encoded")


def codes_of(column: pa.Array) -> Iterator[np.ndarray]:
    """The codes of each document of a batch."""
    for value in column:
        yield np.frombuffer(value.as_buffer(), "<i2")


def masked(texts: list[np.ndarray], stream: np.ndarray, at: np.ndarray, begin: float, end: float) -> np.ndarray:
    """The places whose draw lies between two shares of all draws. A draw depends on the place's number in its text and on its
    neighbours: it is the same on every run and in every round, whatever texts are taken together."""
    sizes = np.array([len(t) for t in texts], np.int64)
    own = np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    luck = (stream[at - 1] * 7919 + stream[at + 1] * 104729 + own * 1299709) % _DRAWS
    return at[(luck >= round(begin * _DRAWS)) & (luck < round(end * _DRAWS))]


def _trainer(sent, begin: float, end: float, rate: float):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = sent.value
        model, squares, places = Model(weights.copy()), np.full(len(weights), 1e-3, np.float32), 0
        waiting, n = [], 0

        def train() -> None:
            nonlocal places
            stream, at = joined_stream(waiting)
            at = masked(waiting, stream, at, begin, end)
            places += len(at)
            for part in np.array_split(at, max(1, -(-len(at) // _BATCH))):
                if len(part):
                    model.step(stream, part, squares, rate)

        for batch in batches:
            for ids in codes_of(batch.column(0)):
                waiting.append(ids)
                n += len(ids)
                if n > _AT_ONCE:
                    train()
                    waiting, n = [], 0
        if n:
            train()
        if places:
            total = np.append(model.flat.astype(np.float64) * places, places)
            total = np.append(total, np.zeros(-len(total) % _LANES)).reshape(-1, _LANES)
            yield pa.record_batch([pa.array(np.arange(len(total))), pa.array(list(total), pa.list_(pa.float64()))], ["block", "lanes"])

    return rows


def trained(texts: DataFrame, share: np.ndarray, rounds=ROUNDS) -> np.ndarray:
    """Weights of the network after training on every document in every round. texts: as `encoded` gives them."""
    context, weights = texts.sparkSession.sparkContext, Model(share=share).flat
    shares = np.cumsum([0.0, *(share for share, _ in rounds)])
    for begin, end, (_, rate) in zip(shares.tolist(), shares[1:].tolist(), rounds):
        sent = context.broadcast(weights)
        parts = texts.select("codes").mapInArrow(_trainer(sent, begin, end, rate), "block bigint, lanes array<double>")
        summed = parts.groupBy("block").agg(*[F.sum(F.col("lanes")[k]).alias(f"l{k}") for k in range(_LANES)])
        rows = sorted(summed.collect())  # as many rows as the network has weights, by the lanes
        if rows:
            total = np.array([r[1:] for r in rows]).ravel()
            weights = (total[: len(weights)] / total[len(weights)]).astype(np.float32)
    return weights


def score(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per document: tokens, summed log-probability of their codes, its mean per token, and the perplexity; the same three of
    the tokens themselves."""
    vocab, counted = vocabulary(docs, text)
    texts = encoded(docs, vocab, text)
    name, sent = f"lm-{uuid.uuid4().hex}", docs.sparkSession.sparkContext.broadcast(trained(texts, vocab.share))

    def column(batch: pa.Array) -> pa.Array:
        model, sums, waiting, n = worker_cache(name, lambda: Model(sent.value)), [], [], 0

        def flush() -> None:
            ends = np.cumsum([len(ids) for ids in waiting])
            each = np.concatenate([[0.0], np.cumsum(model.log_probs(*joined_stream(waiting)), dtype=np.float64)])
            sums.extend(np.diff(each[ends], prepend=0.0).tolist())

        for ids in codes_of(batch):
            waiting.append(ids)
            n += len(ids)
            if n > _AT_ONCE:
                flush()
                waiting, n = [], 0
        if waiting:
            flush()
        return pa.array(sums, pa.float64())

    scored = texts.withColumn("log_prob", per_batch(column, pa.float64())("codes")).drop("codes", "rare")
    if len(vocab.words) == _KNOWN:
        scored = _with_rare(scored, texts, counted)
    n, total = F.col("n_tokens"), F.col("log_prob")
    mean, of_tokens = F.when(n > 0, total / n), total + F.col("own")
    each = F.when(n > 0, of_tokens / n)
    return scored.select(
        "doc_id",
        n,
        total,
        mean.alias("mean_log_prob"),
        F.exp(-mean).alias("perplexity"),
        of_tokens.alias("token_log_prob"),
        each.alias("mean_token_log_prob"),
        F.exp(-each).alias("token_perplexity"),
    )


def _with_rare(scored: DataFrame, texts: DataFrame, counted: DataFrame) -> DataFrame:
    """scored with log(count) of every rare token added to own, in whole units, so that the order of rows does not matter."""
    found = texts.select("row", F.explode("rare").alias("token")).groupBy("row", "token").agg(F.count("*").alias("times"))
    units = F.round(F.log("n") * F.lit(_UNIT)).cast("bigint")
    found = found.join(counted.select("token", units.alias("units")), "token")
    added = found.groupBy("row").agg(F.sum(F.col("times") * F.col("units")).alias("units"))
    return scored.join(added, "row", "left").withColumn("own", F.col("own") + F.coalesce("units", F.lit(0)) / F.lit(_UNIT))
