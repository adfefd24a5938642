"""Alignment of two tokenizers against a plain version that encodes whole texts and counts in dictionaries."""

from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from barwright.llm import alignment
from barwright.llm.common import table
from barwright.llm.queries import QUERIES

A_FILE, B_FILE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(A_FILE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B_FILE)


def byte_of():
    shown = [b for b in range(256) if chr(b).isprintable() and chr(b) != " " and b != 0xAD]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def plain(rows, tokenizers):
    """(doc_id, text) -> result rows, by whole texts and byte positions."""
    a, b = tokenizers
    byte = byte_of()
    found, counts = [], Counter()
    for _, text in rows:
        x = y = []
        cut, links = [], Counter()
        if text:
            x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            xs = [bytes(byte[c] for c in a.id_to_token(t)) for t in x]
            ys = [
                bytes([int(p[3:5], 16)]) if b.is_byte(t) else p.replace("▁", " ").encode()
                for t, p in ((t, b.id_to_piece(t)) for t in y)
            ]
            if not b"".join(xs) == b"".join(ys) == (" " + text).encode():
                x = y = []
            else:
                i = j = p = q = 0
                own_a, own_b = [], []
                while i < len(x) or j < len(y):
                    if p <= q and i < len(x):
                        p += len(xs[i])
                        own_a.append(x[i])
                        i += 1
                    else:
                        q += len(ys[j])
                        own_b.append(y[j])
                        j += 1
                    if p == q:
                        cut.append((own_a, own_b))
                        own_a, own_b = [], []
        for u, v in cut:
            for s in u:
                for t in v:
                    links[s, t] += 1
        counts.update(links.keys())
        said = ";".join(",".join(map(str, u)) + "|" + ",".join(map(str, v)) for u, v in cut)
        found.append((len(x), len(y), len(cut), links, sha256(said.encode()).hexdigest() if x else ""))
    top = defaultdict(int)
    for (s, _), n in counts.items():
        top[s] = max(top[s], n)
    out = []
    for (doc_id, _), (n_a, n_b, n_groups, links, digest) in zip(rows, found):
        best = sum(m for p, m in links.items() if counts[p] == top[p[0]])
        total = sum(m * counts[p] for p, m in links.items())
        out.append((doc_id, n_a, n_b, n_groups, sum(links.values()), best, total, digest))
    return Counter(out)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

AWKWARD = [
    None, "", " ", "   ", "\n", "\t\n x", "a", "a  b", "a   b\n\n  c \t d ", " lead", "trail  ", "it's we'll I'D don't",
    "x▁y", "▁", "<s>hi</s> <|endoftext|> <unk> <0x41>", "a\r\nb);\r\n}\r", "a\x1cb\x1f c", "\xa0nb\xa0sp 　wide　",
    "naïve Straße 中文 слово 🙂🙂 é", "\x00nul\x07", "1234567 12.5% ***---*** ....", "word " * 3000, "long" * 40_000,
    "-" * 5000, "\n" * 300 + "z", " " * 300 + "z", "a b\u0085c", "the cat sat on the mat", "the cat sat on the mat",
]


@pytest.mark.parametrize("most", [131_072, 5, 0])
def test_awkward_texts(spark, tokenizers, most):
    rows = [(k, t) for k, t in enumerate(AWKWARD)] + [(None, "no id"), (3, "   "), (6, "a"), (6, "a")]
    wide = [(d, t, "clash", 1, 2) for d, t in rows]
    docs = spark.createDataFrame(wide, "doc_id bigint, text string, pairs string, `N_A` int, `a.b` int")
    found = alignment.align(docs, A_FILE, B_FILE, most=most)
    assert found.columns == COLUMNS
    assert Counter(map(tuple, found.collect())) == plain(rows, tokenizers)


def test_empty_table(spark):
    assert alignment.align(spark.createDataFrame([], "doc_id bigint, text string"), A_FILE, B_FILE).collect() == []


def test_groups():
    assert alignment.groups([2, 5, 6], [1, 5, 6]) == [(0, 2, 0, 2), (2, 3, 2, 3)]
    assert alignment.groups([], []) == []


def test_query(spark, sf_dir, tokenizers):
    rows = [tuple(r) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    assert Counter(map(tuple, QUERIES["op12_alignment"](spark, sf_dir).select(*COLUMNS).collect())) == plain(rows, tokenizers)


def test_pieces_of_a_batch_are_cut_apart(tokenizers):
    """One pass over the pieces of a batch says of each what a pass over it alone says; pieces whose bytes differ have nothing."""
    aligner = alignment.Aligner(open(A_FILE, encoding="utf-8").read(), open(B_FILE, "rb").read())
    pieces = [" and", " unbelievably", " ▁", "7", " l'été,", " x" * 40]
    both = aligner._a_ids(pieces), aligner._b_ids(pieces)
    together = aligner._aligned(pieces, *both)
    assert together == [aligner._aligned([p], [a], [b])[0] for p, a, b in zip(pieces, *both)]
    assert None in together and together.count(None) < len(pieces)
    for piece, a, b, found in zip(pieces, *both, together):
        if found:
            ends = [[sum(size[:k + 1]) for k in range(len(size))] for size in ([len(aligner.a_bytes[x]) for x in a], [len(aligner.b_bytes[x]) for x in b])]
            cut = alignment.groups(*ends)
            text = ";".join(",".join(map(str, a[p:q])) + "|" + ",".join(map(str, b[r:s])) for p, q, r, s in cut)
            links = [x << 20 | y for p, q, r, s in cut for x in a[p:q] for y in b[r:s]]
            assert found == (len(a), len(b), len(cut), len(links), text.encode(), np.array(links, np.int64).tobytes())
