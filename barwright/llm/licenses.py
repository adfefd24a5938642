"""Licence scans: Aho-Corasick for tags and notice phrases, a shunting-yard parser for licence expressions.

One automaton over the words of a text finds notice phrases; a second one over its lower-cased bytes finds identifier
tags. What follows a tag on its line is parsed as an expression of identifiers, `and`, `or`, `with` and brackets, and
evaluated to how freely the text may be used: `and` takes the lesser value, `or` the greater, an exception after `with`
adds to the value of what it is attached to.

Defined results: null and empty texts have no words, no labels and score 0. An expression that cannot be parsed gives no
label and counts as an unknown licence. Repeated rows give repeated results. Extra columns are ignored.
"""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwright.llm.common import per_batch, plain_words, texts_of, worker_cache

#: The phrases that every scan must count, and their labels.
BASE_PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
#: Further notices.
NOTICES = {
    "affero general public license": "agpl",
    "apache license": "apache",
    "bsd license": "bsd",
    "cc by nc": "cc-by-nc",
    "cc by nc nd": "cc-by-nc-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nd": "cc-by-nd",
    "cc by sa": "cc-by-sa",
    "cc0 1 0": "cc0",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "eclipse public license": "epl",
    "isc license": "isc",
    "lesser general public license": "lgpl",
    "mit license": "mit",
    "mozilla public license": "mpl",
    "no rights reserved": "cc0",
    "permission is hereby granted free of charge": "mit",
    "public domain": "public-domain",
    "redistribution and use in source and binary forms": "bsd",
}
TAGS = ("spdx-license-identifier:", "license-expression:")
#: How freely a text under the licence may be used, by the start of its name; the longest start counts.
FREEDOM = {
    "": 0.5,
    "agpl": 0.2,
    "apache": 1.0,
    "bsd": 1.0,
    "cc-by": 0.9,
    "cc-by-nc": 0.2,
    "cc-by-nd": 0.3,
    "cc-by-sa": 0.6,
    "cc0": 1.0,
    "epl": 0.6,
    "gpl": 0.3,
    "isc": 1.0,
    "lgpl": 0.6,
    "mit": 1.0,
    "mpl": 0.6,
    "public-domain": 1.0,
    "reserved": 0.0,
    "unlicense": 1.0,
}
_EXCEPTION = 0.2
_TOKEN = re.compile(r"[()]|[a-z0-9][a-z0-9.+-]*(?::[a-z0-9.+-]+)?")
#: The end of an expression after a tag.
_END = re.compile(r"[\r\n]|\*/|-->")
_RANK = {"or": 1, "and": 2, "with": 3}


def freedom(name: str) -> float:
    return FREEDOM[max((p for p in FREEDOM if name.startswith(p)), key=len)]


def postfix(expression: str) -> list[str] | None:
    """The expression with operators after their operands, by the shunting-yard method; None if it is malformed."""
    text = expression.lower()
    tokens = _TOKEN.findall(text)
    if not tokens or _TOKEN.sub("", text).strip():
        return None
    out: list[str] = []
    waiting: list[str] = []
    operand_due = True
    for t in tokens:
        if t == "(":
            if not operand_due:
                return None
            waiting.append(t)
        elif t == ")":
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if operand_due or not waiting:
                return None
            waiting.pop()
        elif t in _RANK:
            if operand_due:
                return None
            while waiting and waiting[-1] != "(" and _RANK[waiting[-1]] >= _RANK[t]:
                out.append(waiting.pop())
            waiting.append(t)
            operand_due = True
        else:
            if not operand_due:
                return None
            out.append(t)
            operand_due = False
    if operand_due or "(" in waiting:
        return None
    return out + waiting[::-1]


def evaluate(expression: str) -> tuple[float, list[str]] | None:
    """Freedom of use and the identifiers named; None if the expression is malformed."""
    terms = postfix(expression)
    if terms is None:
        return None
    stack: list[tuple[float, list[str]]] = []
    for t in terms:
        if t not in _RANK:
            stack.append((freedom(t), [t]))
            continue
        (b, right), (a, left) = stack.pop(), stack.pop()
        if t == "with":
            if len(right) != 1:
                return None
            stack.append((min(1.0, a + _EXCEPTION), left))
        else:
            stack.append((min(a, b) if t == "and" else max(a, b), left + right))
    return stack[0]


def _automata():
    phrases, tags = ahocorasick.Automaton(), ahocorasick.Automaton()
    for phrase in {**NOTICES, **BASE_PHRASES}:
        phrases.add_word(f" {phrase} ", phrase)
    for tag in TAGS:
        tags.add_word(tag, tag)
    phrases.make_automaton()
    tags.make_automaton()
    return phrases, tags


_SCAN = pa.struct(
    [
        ("n_words", pa.int64()),
        ("n_base", pa.int64()),
        ("first_word", pa.int64()),
        ("last_word", pa.int64()),
        ("base_labels", pa.string()),
        ("labels", pa.string()),
        ("score", pa.float64()),
        ("findings", pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64()), ("phrase", pa.string())]))),
        ("expressions", pa.list_(pa.string())),
    ]
)


def scan_text(text: bytes, phrases, tags) -> dict:
    words = plain_words(text)
    # Latin-1 keeps one character per byte: positions stay byte positions.
    flat = (b" " + b" ".join(words) + b" ").decode("latin-1") if words else ""
    findings, starts, base = [], [], set()
    word = at = 0
    for end, phrase in sorted(((e, p) for e, p in phrases.iter(flat)), key=lambda x: (x[0] - len(x[1]), x)):
        start = end - len(phrase) - 1
        word += flat.count(" ", at, start)
        at = start
        if phrase in BASE_PHRASES:
            starts.append(word)
            base.add(BASE_PHRASES[phrase])
        findings.append({"label": BASE_PHRASES.get(phrase) or NOTICES[phrase], "word": word, "phrase": phrase})
    labels = {f["label"] for f in findings}
    values = [freedom(x) for x in labels]
    low = text.lower().decode("latin-1")
    expressions, stop = [], 0
    for end, _ in tags.iter(low):
        if stop <= end:  # the tags of one line share its end
            found = _END.search(low, end + 1)
            stop = found.start() if found else len(low)
        expression = low[end + 1 : stop].strip(" \t#*;\"'")
        parsed = evaluate(expression)
        expressions.append(expression.encode("latin-1").decode("utf-8", "replace"))
        values.append(parsed[0] if parsed else freedom(""))
        labels |= set(parsed[1] if parsed else ())
    return {
        "n_words": len(words),
        "n_base": len(starts),
        "first_word": min(starts, default=None),
        "last_word": max(starts, default=None),
        "base_labels": ",".join(sorted(base)),
        "labels": ",".join(sorted(labels)),
        "score": 1.0 - min(values) if values else 0.0,
        "findings": findings,
        "expressions": expressions,
    }


def _scan(text: pa.Array) -> pa.Array:
    phrases, tags = worker_cache("licence-automata", _automata)
    return pa.array([scan_text(t, phrases, tags) for t in texts_of(text)], _SCAN)


def scan(docs: DataFrame) -> DataFrame:
    """One row per document. `score` is how far the strictest statement restricts use (0: not at all, or no statement)."""
    found = docs.select("doc_id", per_batch(_scan, _SCAN)(docs["text"]).alias("scan"))
    return found.select("doc_id", *[F.col(f"scan.{f.name}").alias(f.name) for f in _SCAN])
