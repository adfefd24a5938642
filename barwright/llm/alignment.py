"""Cross-tokenizer alignment: groups of tokens of two tokenizers that cover the same bytes, and how usual their links are.

Both tokenizers read a space and the text. The ends of tokens in bytes are summed up along the text, for all new pieces of a batch
in one array per tokenizer; the ends that both know, sorted, cut both id lists into groups, and all pairs inside a group are
links. Neither tokenizer merges from a character that is no white space into white space, or from a letter into a full stop, comma
and the like, so a text is cut there, and a worker keeps what it found for a piece; a piece's end is always a common end. The
vocabularies are asked whether that holds: signs that break it do not cut, and texts with white space that breaks it stay whole.

Corpus-wide counts: every document's distinct links are written once; an aggregation counts the documents of each id pair. A
table of the most frequent pairs, cut at a count so that it never has more than TABLE rows, is broadcast and answers most
links in the map tasks; the links of the other pairs are joined with the counts. Which pairs the table holds changes no result.

Defined results: null and empty texts, and texts whose tokens do not give back space + text (a literal U+2581, bytes that are no
UTF-8), have no tokens: zeros and an empty `groups_sha256`. Strings of special tokens are plain text. Repeated rows count as
documents of their own. Null ids are allowed. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import gc
import json
import os
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwright.llm.common import durable, named, worker_cache, written

#: Most pairs in the broadcast table; pieces in each half of a worker's cache, and the longest piece kept in it, in characters.
TABLE, CACHED, CACHED_CHARS = 131_072, 150_000, 48
#: Texts that are taken together.
_TEXTS = 256
#: Bits of the second id in a pair's key.
_LOW = 20
_SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0  -     　"
_LETTERS, _SIGNS = "A-Za-zÀ-ÖØ-öø-ɏ", ",.;:!?"
#: The split of byte-level vocabularies in front of their merges (fixed value).
_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Longer pieces are left to the library that the vocabulary file is made for.
_RANKED_CHARS = 256
_NO_TOKENS = (0, 0, 0, 0, b"", b"")


def _byte_alphabet() -> dict[str, int]:
    """Character to byte of byte-level vocabularies: printable bytes stand for themselves, the others follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def stretches(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The common ends, and (from, to) in the first and in the second array of every stretch between two of them."""
    size = max([0, *a_ends[-1:], *b_ends[-1:]]) + 1
    in_a, in_b = (np.bincount(x, minlength=size) for x in (a_ends, b_ends))
    ends = np.flatnonzero((in_a > 0) & (in_b > 0))
    a_to, b_to = (np.cumsum(x)[ends] for x in (in_a, in_b))
    return ends, np.concatenate([[0], a_to])[:-1], a_to, np.concatenate([[0], b_to])[:-1], b_to


def groups(a_ends: list[int], b_ends: list[int]) -> list[tuple[int, int, int, int]]:
    """(from, to) of the first and of the second list for every stretch between two common ends."""
    return list(zip(*(x.tolist() for x in stretches(np.array(a_ends, np.int64), np.array(b_ends, np.int64))[1:])))


def ranked(a_json: str, entries: list[bytes]):
    """The same byte-level merges by rank, which encode short pieces much faster; None if the file is of another kind.

    Merging by rank does the same as merging by the list if every merge makes an entry of a higher id than those before it."""
    made = json.loads(a_json)
    model, split = made["model"], made["pre_tokenizer"] or {}
    plain = made["normalizer"] is None and split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
    if not plain or model["type"] != "BPE" or model["dropout"] or model["unk_token"] or model.get("ignore_merges"):
        return None
    merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if merged != sorted(set(merged)):
        return None
    import tiktoken

    added = {t["id"] for t in made["added_tokens"]}
    ranks = {entries[k]: k for k in model["vocab"].values() if k not in added}
    return tiktoken.Encoding(uuid.uuid4().hex, pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})


class Aligner:
    """Pieces of a text -> (tokens A, tokens B, groups, links, the groups as text, bytes of the pair keys with repeats), or None if the bytes differ."""

    def __init__(self, a_json: str, b_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        alphabet = _byte_alphabet()
        # An added token that is no byte-level entry has no bytes here; it never comes out of plain text.
        entry = lambda t: bytes(map(alphabet.__getitem__, t)) if all(c in alphabet for c in t) else b""
        self.a_bytes = [entry(self.a.id_to_token(k) or "") for k in range(self.a.get_vocab_size())]
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        byte = re.compile(r"<0x([0-9A-F]{2})>")
        self.b_bytes = [
            bytes([int(m[1], 16)]) if (m := byte.fullmatch(p)) else p.replace("▁", " ").encode("utf-8") for p in pieces
        ]
        self.a_size, self.b_size = [len(x) for x in self.a_bytes], [len(x) for x in self.b_bytes]
        self.a_sizes, self.b_sizes = np.array(self.a_size, np.int64), np.array(self.b_size, np.int64)
        #: Ids in decimal, four times: in front of another one, of the other tokenizer's, of the next group, of nothing.
        numbers = [str(k).encode() for k in range(max(len(self.a_bytes), len(self.b_bytes)))]
        self.said = np.array([n + sign for sign in (b",", b"|", b";", b"") for n in numbers], object)
        self.ranks = ranked(a_json, self.a_bytes)
        # White space that an entry holds behind another character: texts with it are not cut.
        entries = [*pieces, *(x.decode("utf-8", "ignore") for x in self.a_bytes)]
        behind = re.compile(f"(?<=[^{_SPACES}▁])[{_SPACES}▁]")
        bound = {c.replace("▁", " ") for p in entries for c in behind.findall(p)}
        bound |= set("\x1c\x1d\x1e\x1f")  # white space to some readers only
        self.whole = re.compile("[" + "".join(sorted(map(re.escape, bound))) + "]")
        inside = re.compile(f"(?<=[{_LETTERS}])[{_SIGNS}]")
        signs = re.escape("".join(sorted(set(_SIGNS) - {c for p in entries for c in inside.findall(p)})))
        words = f"[{_SPACES}]*[^{_SPACES}{signs}]+(?<=[{_LETTERS}])(?=[{signs}])|" if signs else ""
        self.piece = re.compile(f"{words}[{_SPACES}]*[^{_SPACES}]+|[{_SPACES}]+")
        self.mark = self.b.encode("\n")  # what stands before a text that begins with a line end: the added space, the line end
        self.cuts = " " not in bound and not any("\n" in p for p in pieces) and len(self.mark) == 2
        self.known: dict[str, tuple | None] = {}
        self.older: dict[str, tuple | None] = {}

    def pieces(self, text: str) -> list[str]:
        spaced = " " + text
        return [spaced] if not self.cuts or self.whole.search(text) else self.piece.findall(spaced)

    def _a_ids(self, pieces: list[str]) -> list[list[int]]:
        if self.ranks is None:
            return [e.ids for e in self.a.encode_batch_fast(pieces, add_special_tokens=False)]
        own, long = self.ranks.encode_ordinary, lambda p: self.a.encode(p, add_special_tokens=False).ids
        return [own(p) if len(p) <= _RANKED_CHARS else long(p) for p in pieces]

    def _b_ids(self, pieces: list[str]) -> list[list[int] | None]:
        """The tokenizer adds a space, which stands for the piece's own; other pieces follow a line end, whose tokens go."""
        found = self.b.encode([p[1:] if p[0] == " " else "\n" + p for p in pieces], num_threads=1)
        for k, p in enumerate(pieces):
            if p == " ":
                found[k] = self.mark[:1]  # at the end of a text
            elif p[0] != " ":
                found[k] = found[k][2:] if found[k][:2] == self.mark else None
        return found

    def _aligned(self, pieces: list[str], a: list[list[int]], b: list[list[int] | None]) -> list[tuple | None]:
        """What is known of each piece. The ends of all pieces' tokens go through `stretches` as one sequence: a piece's end is common."""
        out: list[tuple | None] = [None] * len(pieces)
        bodies = [p.encode("utf-8") for p in pieces]
        b_bytes, a_size = self.b_bytes.__getitem__, self.a_size.__getitem__
        held = [
            k
            for k, (body, x, y) in enumerate(zip(bodies, a, b))
            if y is not None and b"".join(map(b_bytes, y)) == body and sum(map(a_size, x)) == len(body)
        ]
        if not held:
            return out
        a_many, b_many = ([len(own[k]) for k in held] for own in (a, b))
        a_ids, b_ids = (
            np.fromiter(chain.from_iterable([own[k] for k in held]), np.int64, sum(many)) for own, many in ((a, a_many), (b, b_many))
        )
        a_ends, b_ends = np.cumsum(self.a_sizes[a_ids]), np.cumsum(self.b_sizes[b_ids])
        piece_ends = np.cumsum([len(bodies[k]) for k in held])
        ends, a_from, a_to, b_from, b_to = stretches(a_ends, b_ends)
        # All pairs inside a group.
        wide = b_to - b_from
        many = (a_to - a_from) * wide
        group = np.repeat(np.arange(len(ends)), many)
        before = np.concatenate([[0], np.cumsum(many)])
        place = np.arange(before[-1]) - before[group]
        keys = (a_ids[a_from[group] + place // wide[group]] << _LOW | b_ids[b_from[group] + place % wide[group]]).tobytes()
        # The text: tokens by group, those of A first, each with the sign behind it.
        a_at = np.arange(len(a_ids)) + np.repeat(b_from, a_to - a_from)
        b_at = np.arange(len(b_ids)) + np.repeat(a_to, wide)
        said = np.empty(len(a_ids) + len(b_ids), np.int64)
        said[a_at], said[b_at] = a_ids, b_ids
        last = np.searchsorted(ends, piece_ends) + 1  # groups up to the end of each piece
        said[a_at[a_to - 1]] += len(self.said) // 4
        said[b_at[b_to - 1]] += len(self.said) // 2
        said[b_at[b_to[last - 1] - 1]] += len(self.said) // 4
        text = self.said[said].tolist()
        cut = np.concatenate([[0], last])
        n_groups, links = np.diff(cut).tolist(), (before[cut] * 8).tolist()
        begin = 0
        for k, n_a, n_b, n_groups_own, k0, k1 in zip(held, a_many, b_many, n_groups, links, links[1:]):
            end = begin + n_a + n_b
            out[k] = (n_a, n_b, n_groups_own, (k1 - k0) // 8, b"".join(text[begin:end]), keys[k0:k1])
            begin = end
        return out

    def table(self, pieces: set[str]) -> dict[str, tuple | None]:
        """What is known of the pieces; each new one is encoded once. The cache has a newer and an older half."""
        if len(self.known) > CACHED:
            self.known, self.older = {}, self.known
        known, older, out, new = self.known, self.older, {}, []
        for p in pieces:
            if p in known:
                out[p] = known[p]
            elif p in older:
                out[p] = known[p] = older[p]
            else:
                new.append(p)
        for p, found in zip(new, self._aligned(new, self._a_ids(new), self._b_ids(new))):
            out[p] = found
            if len(p) <= CACHED_CHARS:
                known[p] = found
        return out

    def rows(self, texts: list[bytes | None]) -> list[tuple]:
        """For each text: (n_a, n_b, n_groups, n_links, digest, distinct pair keys, how often each is linked)."""
        cut = []
        for t in texts:
            try:
                cut.append(self.pieces(t.decode("utf-8")) if t else [])
            except UnicodeDecodeError:
                cut.append([])
        entries = self.table(set().union(*cut)) if cut else {}
        code = dict(zip(entries, range(len(entries))))
        listed = [e or _NO_TOKENS for e in entries.values()]
        n_as, n_bs, n_cuts, width, said, linked_keys = zip(*listed) if listed else ((),) * 6
        numbers = np.array([n_as, n_bs, n_cuts, width], np.int64).T
        bad = {p for p, e in entries.items() if e is None}
        width = np.array(width, np.int64)
        keys = np.frombuffer(b"".join(linked_keys), np.int64)
        start = np.concatenate([[0], np.cumsum(width)])
        out = []
        for own in cut:
            if not own or bad and not bad.isdisjoint(own):
                out.append((0, 0, 0, 0, "", np.empty(0, np.int64), np.empty(0, np.int64)))
                continue
            at = list(map(code.__getitem__, own))
            digest = sha256(b";".join(map(said.__getitem__, at))).hexdigest()
            used, times = np.unique(np.array(at, np.int64), return_counts=True)
            n_a, n_b, n_groups, n_links = (times @ numbers[used]).tolist()
            many = width[used]
            place = np.repeat(start[used] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
            pair, back = np.unique(keys[place], return_inverse=True)
            linked = np.bincount(back, weights=np.repeat(times, many)).astype(np.int64)
            out.append((n_a, n_b, n_groups, n_links, digest, pair, linked))
        return out


@contextmanager
def _no_collection() -> Iterator[None]:
    """Hundreds of thousands of small tuples come and go here, none of them in a cycle: the collector would only count them."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


def _lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*parts, np.empty(0, np.int64)])))


_ALIGNED = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs array<bigint>, times array<bigint>"


def aligned(docs: DataFrame, a_file: str, b_file: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's token, group and link numbers, the digest of its groups, and its distinct links: pair keys
    (id of A * 2^20 + id of B) and how often each is linked."""
    with open(a_file, encoding="utf-8") as file:
        vocabulary = file.read()
    with open(b_file, "rb") as file:
        model = file.read()
    sent = docs.sparkSession.sparkContext.broadcast((vocabulary, model))  # the vocabularies
    name = f"alignment-{uuid.uuid4().hex}"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = worker_cache(name, lambda: Aligner(*sent.value), most=1)
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for at in range(0, batch.num_rows, _TEXTS):
                with _no_collection():
                    found = aligner.rows(texts.slice(at, _TEXTS).to_pylist())
                columns = [pa.array([r[k] for r in found], pa.int64()) for k in range(4)]
                digest = pa.array([r[4] for r in found], pa.string())
                lists = [_lists([r[k] for r in found]) for k in (5, 6)]
                yield pa.record_batch(
                    [batch.column(0).slice(at, _TEXTS).cast(pa.int64()), *columns, digest, *lists],
                    ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"],
                )

    slim = docs.select(named(docs, id_column).cast("bigint").alias("doc_id"), named(docs, text).alias("text"))
    return slim.mapInArrow(rows, _ALIGNED)


def _cutoff(counts: DataFrame, most: int) -> int:
    """The least count from which on there are at most `most` pairs; from a histogram of bounded size."""
    step = F.floor(F.log2(F.col("n").cast("double")) * 16)
    bins = counts.groupBy(step.alias("bin")).agg(F.count("*").alias("pairs"), F.min("n").alias("least")).collect()
    left, cut = most, 1 << 62
    for r in sorted(bins, key=lambda r: -r["bin"]):
        left -= r["pairs"]
        if left < 0:
            break
        cut = r["least"]
    return cut


def pair_counts(links: DataFrame) -> DataFrame:
    """(pair, n, best): the documents that hold the pair, and whether no pair of its A id is held by more."""
    counts = durable(links.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")))
    a = F.shiftright("pair", _LOW)
    top = counts.groupBy(a.alias("a")).agg(F.max("n").alias("top"))
    return counts.withColumn("a", a).join(top, "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def _looked_up(sent):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = (np.frombuffer(x, t) for x, t in zip(sent.value, (np.int64, np.int64, np.bool_)))
        for batch in batches:
            offsets = batch.column("pairs").offsets.to_numpy()
            own = batch.column("pairs").values.to_numpy()[offsets[0] : offsets[-1]]
            times = batch.column("times").values.to_numpy()
            begin = batch.column("times").offsets.to_numpy()
            times = times[begin[0] : begin[-1]]
            row = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            place = np.minimum(np.searchsorted(pair, own), max(0, len(pair) - 1))
            hit = pair[place] == own if len(pair) else np.zeros(len(own), bool)
            got = place[hit]
            sums = [np.zeros(batch.num_rows, np.int64) for _ in range(2)]
            if len(got):
                np.add.at(sums[0], row[hit], times[hit] * best[got])
                np.add.at(sums[1], row[hit], times[hit] * n[got])
            missing = np.bincount(row[~hit], minlength=batch.num_rows)
            at = pa.array(np.concatenate([[0], np.cumsum(missing)]).astype(np.int32))
            kept = [batch.column(k) for k in ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")]
            lists = [pa.ListArray.from_arrays(at, pa.array(x[~hit])) for x in (own, times)]
            yield pa.record_batch(
                [*kept, *map(pa.array, sums), *lists],
                ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "best_part", "sum_part", "pairs", "times"],
            )

    return rows


def align(docs: DataFrame, a_file: str, b_file: str, id_column: str = "doc_id", text: str = "text", most: int = TABLE) -> DataFrame:
    """One row per document: tokens, groups, links, how many links are the most usual ones of their A token (ties included), the sum of
    all links' document counts, and the digest of the groups."""
    spark = docs.sparkSession
    links = aligned(docs, a_file, b_file, id_column, text).withColumn("row", F.monotonically_increasing_id())
    links = written(links, "alignment-links")
    counts = written(pair_counts(links), "alignment-counts")
    frequent = counts.where(F.col("n") >= _cutoff(counts, most)).select("pair", "n", "best").toPandas()  # at most `most` rows
    frequent = frequent.sort_values("pair")
    sent = spark.sparkContext.broadcast(
        tuple(frequent[c].to_numpy(t).tobytes() for c, t in (("pair", np.int64), ("n", np.int64), ("best", np.bool_)))
    )
    looked = links.mapInArrow(
        _looked_up(sent),
        "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
        "best_part bigint, sum_part bigint, pairs array<bigint>, times array<bigint>",
    )
    looked = written(looked, "alignment-looked-up")
    rest = looked.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", "x.*")
    rest = rest.withColumnRenamed("pairs", "pair").join(counts, "pair").groupBy("row")
    rest = rest.agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("best_rest"), F.sum(F.col("times") * F.col("n")).alias("sum_rest"))
    zero = F.lit(0).cast("bigint")
    return looked.join(rest, "row", "left").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        (F.col("best_part") + F.coalesce("best_rest", zero)).alias("n_best"),
        (F.col("sum_part") + F.coalesce("sum_rest", zero)).alias("count_sum"),
        "groups_sha256",
    )
