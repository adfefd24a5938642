"""The text operators against brute-force versions on a small table with every awkward row."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from barwright.llm import (
    decontaminate,
    jaccard_join,
    licenses,
    masked_lm,
    packing,
    quality_net,
    quality_rules,
    sharding,
    surrogates,
    token_counts,
)

PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words string, `SHARD` int, `a.b` int"

PASSAGE = " ".join(f"passage{i}" for i in range(30))
STORY = " ".join(f"w{i * i % 97} x{i}" for i in range(80))


def awkward():
    texts = [
        STORY,
        STORY,
        STORY.replace("x3 ", "y3 "),
        STORY.upper(),
        None,
        "",
        " \t\n ",
        "one",
        "one two three",
        "One Two Three",
        "É é ß 中文 word\x0bword\x0cword\x1cword",
        "head " + PASSAGE + " tail",
        PASSAGE[: len(PASSAGE) // 2],
        "short item and more",
        "All rights reserved. cc by CC-BY, GNU General Public License\n/* SPDX-License-Identifier: MIT OR Apache-2.0 */",
        "mail ann.lee@mail.example.org or +1 (415) 555-0199; card 4111 1111 1111 1111, not 4111111111111112; host 10.1.2.3.",
        'again Ann.Lee@mail.example.org token = "0123456789abcdef0123456789abcdef01234567" and Dr. Mary Jones met Ms. Jones',
        "bad *** $$$ words### " * 30,
        "same line here\n" * 12,
        "word " * 3000,
        STORY + " " + PASSAGE,
        "<|endoftext|> it's a x<|startoftext|>y don't",
    ]
    rows = [(k, t, "en" if k % 2 else None, "src0", None, "clash", k, k) for k, t in enumerate(texts)]
    rows += [(None, STORY, None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    rows += [rows[0], rows[0], rows[7]]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(awkward(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def bench(spark):
    items = [(1, PASSAGE), (2, "short item"), (3, None), (4, "!!"), (5, PASSAGE), (None, "one"), (6, "three")]
    return spark.createDataFrame(items, "item_id bigint, text string")


def words(pattern, text, low=True):
    return pattern.findall((text or "").translate(LOW) if low else text or "")


def same(df, expected):
    assert Counter(tuple(r) for r in df.collect()) == Counter(expected)


@pytest.mark.parametrize("block_bytes", [8 << 20, 100])
def test_decontamination(docs, bench, block_bytes):
    patterns = defaultdict(set)
    for item, text in [(1, PASSAGE), (2, "short item"), (5, PASSAGE), (6, "three")]:
        w = words(PLAIN, text)
        for i in range(max(1, len(w) - 12)):
            patterns[tuple(w[i : i + 13])].add(str(item))
    expected = []
    for doc_id, text, *_ in awkward():
        w, hit, items = words(PLAIN, text), set(), set()
        for p, owners in patterns.items():
            for i in range(len(w) - len(p) + 1):
                if tuple(w[i : i + len(p)]) == p:
                    hit |= set(range(i, i + len(p)))
                    items |= owners
        digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        expected.append((doc_id, len(w), len(hit), len(items), digest, len(hit) > 0 and 20 * len(hit) >= len(w)))
    same(decontaminate.contamination(docs, bench, block_bytes=block_bytes).drop("spans"), expected)
    kept = decontaminate.drop_contaminated(docs, bench, block_bytes=block_bytes)
    assert kept.columns == docs.columns and kept.count() == sum(not e[-1] for e in expected)
    assert decontaminate.contamination(docs, bench.limit(0)).where("contaminated").isEmpty()


def test_wu_manber_finds_what_a_scan_finds():
    import random

    r = random.Random(3)
    for _ in range(200):
        text = [b"abc"[k : k + 1] for k in (r.randrange(3) for _ in range(60))]
        patterns = {tuple(text[i : i + n]) for n in (r.randint(1, 5), 6) for i in [r.randrange(50)]}
        patterns.add(tuple(r.choice([b"a", b"b", b"c"]) for _ in range(r.randint(1, 6))))
        found = decontaminate.WuManber(patterns)
        spans = {(a, b, found.patterns[k]) for a, b, k in found.find(text)}
        assert spans == {(i, i + len(p), p) for p in patterns for i in range(len(text)) if tuple(text[i : i + len(p)]) == p}


def test_licences(docs):
    phrases = {("cc", "by"): "cc-by", ("general", "public", "license"): "gpl", ("all", "rights", "reserved"): "reserved"}
    expected = []
    for doc_id, text, *_ in awkward():
        w, starts, labels = words(PLAIN, text), [], set()
        for p, label in phrases.items():
            at = [i for i in range(len(w)) if tuple(w[i : i + len(p)]) == p]
            starts += at
            labels |= {label} if at else set()
        expected.append((doc_id, len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))))
    out = licenses.scan(docs)
    same(out.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"), expected)
    assert out.where("score < 0 or score > 1 or score is null").isEmpty()
    assert out.where("doc_id = 14").first()["labels"] == "apache-2.0,cc-by,gpl,mit,reserved"


@pytest.mark.parametrize(
    "text, value",
    [
        ("MIT", (1.0, ["mit"])),
        ("GPL-2.0-only WITH Classpath-exception-2.0 AND MIT", (0.5, ["gpl-2.0-only", "mit"])),
        ("GPL-3.0 OR (MIT AND MPL-2.0)", (0.6, ["gpl-3.0", "mit", "mpl-2.0"])),
        ("MIT OR", None),
        ("(MIT", None),
        ("MIT Apache-2.0", None),
        ("", None),
        ("MIT WITH (A OR B)", None),
        ("MIT & X", None),
    ],
)
def test_licence_expressions(text, value):
    assert licenses.evaluate(text) == value


def test_token_counts(docs):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    expected = []
    for doc_id, text, *_ in awkward():
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        expected.append((doc_id, len((text or "").encode()), n, n > 2048))
    same(token_counts.token_counts(docs, path), expected)


def test_quality_measures(docs, spark):
    labels = spark.createDataFrame([(1, 1), (2, None), (3, 0), (3, 1), (None, 1)], "doc_id bigint, quality int")
    expected = []
    for doc_id, text, *_ in awkward():
        t, w = text or "", words(SPACED, text, low=False)
        lines = [x for x in t.split("\n") if SPACED.search(x)]
        grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        seen, repeated = Counter(grams), set()
        for i, g in enumerate(grams):
            if seen[g] > 1:
                repeated |= set(range(i, i + 5))
        failed = len(w) < 10 or 100 * len(repeated) > 20 * len(w)
        symbols = sum(c in "#*$%&|<>" for c in t)
        expected.append((doc_id, len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(repeated), failed))
    out = quality_rules.apply_rules(docs, labels)
    same(out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"), expected)
    assert out.where("kept and base_failed").isEmpty()
    assert out.where("kept = base_failed").isEmpty()  # too few labels: the base rule alone decides


def test_certified_cutoffs_keep_their_promise():
    import math

    for k, n, p in [(0, 10, 0.3), (3, 20, 0.1), (5, 5, 0.5), (40, 1000, 0.05)]:
        plain = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert abs(quality_rules.binomial_tail(k, n, p) - plain) < 1e-9
    rejected = [0] * 40 + [3] * 4 + [200] * 4
    best = quality_rules.strictest(rejected, 2000, 0.01, 0.001)
    assert best == 43
    assert quality_rules.strictest([0] * 48, 50, 0.01, 0.001) is None


def test_packing(docs, spark):
    out = packing.pack(docs, max_len=100, n_buckets=4, token_budget=300, part_rows=7)
    expected = []
    for doc_id, text, *_ in awkward():
        n = len(words(SPACED, text, low=False))
        expected += [(doc_id, s, s * 100, min(100, n - s * 100)) for s in range(max(1, -(-n // 100)))]
    same(out.select("doc_id", "segment", "start_token", "n_tokens"), expected)
    rows = out.collect()
    lengths = {r["bucket_len"] for r in rows}
    assert len(lengths) <= 4 and all(r["n_tokens"] == r["bucket_len"] - r["padding"] and r["padding"] >= 0 for r in rows)
    for length in lengths:
        places = sorted((r["batch"], r["place"]) for r in rows if r["bucket_len"] == length)
        size = max(1, 300 // max(length, 1))
        assert places == [(k // size, k % size) for k in range(len(places))]
    assert packing.pack(docs.limit(0)).count() == 0


def test_optimal_boundaries():
    import itertools
    import random

    r = random.Random(1)
    for _ in range(150):
        h = {r.randint(0, 30): r.randint(1, 9) for _ in range(r.randint(1, 8))}
        k, lengths = r.randint(1, 4), sorted(h)
        cost = lambda b: sum(c * (min(x for x in b if x >= n) - n) for n, c in h.items())  # noqa: B023, E731
        best = min(
            cost([*c, lengths[-1]]) for m in range(min(k, len(lengths))) for c in itertools.combinations(lengths[:-1], m)
        )
        found = packing.optimal_boundaries(h, k)
        assert len(found) <= k and cost(found) == best


def test_sharding(docs, spark):
    rows = sharding.shard(docs, n_shards=4).collect()
    expected = Counter((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t, *_ in awkward())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == expected
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(4))
    assert sharding.shard(docs.limit(0)).count() == 0


def test_shards_are_even_and_hot_texts_are_split(spark):
    hot = spark.range(9000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot text").otherwise(F.sha2(F.col("id").cast("string"), 256)).alias("text")
    )
    rows = sharding.shard(hot, n_shards=10)
    sizes = [r["b"] for r in rows.groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(sizes) == 10 and max(sizes) < 1.05 * sum(sizes) / 10 and min(sizes) > 0.95 * sum(sizes) / 10


def components(rows, near=85):
    """(doc_id, n_shingles, component) by comparing all sets with each other."""
    sets = []
    for _, text, *_ in rows:
        w = words(SPACED, text)
        sets.append(frozenset([tuple(w)] if 0 < len(w) < 4 else zip(w, w[1:], w[2:], w[3:])))
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            n = len(a & sets[j])
            if a and sets[j] and 100 * n >= near * (len(a) + len(sets[j]) - n):
                up[root(i)] = root(j)
    groups = defaultdict(list)
    for k in range(len(rows)):
        groups[root(k)].append(k)
    out = []
    for members in groups.values():
        least = min((rows[k][0] for k in members if rows[k][0] is not None), default=None)
        out += [(rows[k][0], len(sets[k]), least) for k in members]
    return out, len(groups)


def test_jaccard_join(docs):
    expected, n_groups = components(awkward())
    same(jaccard_join.near_components(docs), expected)
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == n_groups


@pytest.mark.parametrize("leaf_rows", [4_096, 5])
def test_jaccard_join_of_families(spark, leaf_rows):
    import random

    r = random.Random(5)
    rows = []
    for family in range(6):
        base = [f"f{family}w{i}" for i in range(40 + 30 * family)]
        for _ in range(12):
            text = list(base)
            for _ in range(r.randrange(0, 6)):
                text[r.randrange(len(text))] = f"new{r.random()}"
            rows.append((len(rows), " ".join(text)))
    rows += [(len(rows) + k, f"tiny {k % 3} a b c d e f") for k in range(9)]
    r.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    same(jaccard_join.near_components(frame, leaf_rows=leaf_rows), components(rows)[0])


def test_linking_in_memory_is_exact():
    import random

    import numpy as np

    r = random.Random(2)
    sets = []
    for _ in range(300):
        base = r.randrange(20) * 1000
        sets.append(np.unique(np.array([base + r.randrange(30) for _ in range(60)], np.uint64)))
    forest = jaccard_join.link_in_memory(sets, leaf=16)
    plain = jaccard_join.Forest(len(sets))
    for i in range(len(sets)):
        for j in range(i):
            n = len(np.intersect1d(sets[i], sets[j]))
            if 100 * n >= 85 * (len(sets[i]) + len(sets[j]) - n):
                plain.join(i, j)
    assert [forest.root(k) for k in range(len(sets))] == [plain.root(k) for k in range(len(sets))]


def test_surrogates(docs):
    out = surrogates.replace_entities(docs, "key")
    assert out.columns == [*docs.columns, "n_replaced", "kinds"]
    rows = {r["doc_id"]: r for r in out.collect() if r["doc_id"] is not None}
    a, b = rows[15]["text"], rows[16]["text"]
    for secret in ("ann.lee", "Ann.Lee", "555-0199", "4111 1111 1111 1111", "10.1.2.3", "0123456789abcdef0123", "Mary", "Jones"):
        assert secret not in a and secret not in b
    assert "4111111111111112" in a  # fails the Luhn check
    assert rows[15]["kinds"] == ["CARD", "EMAIL", "IP", "PHONE"] and rows[16]["kinds"] == ["EMAIL", "PERSON", "SECRET"]
    mail = re.compile(r"\S+@\S+\.example")
    assert mail.search(a).group().strip(";") == mail.search(b).group().strip(";")
    card = re.search(r"card (\d{4} \d{4} \d{4} \d{4}),", a).group(1).replace(" ", "")
    digits = [int(c) for c in reversed(card)]
    assert (sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])) % 10 == 0
    assert re.search(r"\+1 \(\d{3}\) \d{3}-\d{4};", a)
    names = re.search(r"Dr\. (\w+) (\w+) met Ms\. (\w+)$", b)
    assert names.group(2) == names.group(3) and names.group(1).endswith("a")
    others = {k: r["text"] for k, r in rows.items() if k not in (15, 16)}
    assert others == {r[0]: r[1] for r in awkward() if r[0] in others}
    assert out.count() == docs.count() and surrogates.replace_entities(docs.limit(0), "key").count() == 0


def test_surrogates_stay_different(spark, monkeypatch):
    mails = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("to "), F.col("id").cast("string"), F.lit("@a.org")).alias("text"))
    new = surrogates.replace_entities(mails, "key").select("text").distinct()
    assert new.count() == 400
    old = mails.select("text")
    assert new.intersect(old).isEmpty()


def test_classifier_and_language_model_take_every_row(docs, spark):
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(22)] + [(3, 0, 0), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    out = quality_net.classify(docs, labels)
    same(out.select("doc_id", "held_out"), [(d, d is not None and zlib.crc32(str(d).encode()) % 5 == 0) for d, *_ in awkward()])
    assert out.where("score is null or score < 0 or score > 1 or predicted != cast(score >= 0.3 as int)").isEmpty()
    assert quality_net.classify(docs, labels.limit(0)).where("score != 0.5").isEmpty()
    scored = masked_lm.score(docs)
    assert scored.count() == docs.count() and scored.where("log_prob > 0 or (n_tokens = 0) != (mean_log_prob is null)").isEmpty()
    assert masked_lm.score(docs.limit(0)).count() == 0 and quality_net.classify(docs.limit(0), labels).count() == 0
