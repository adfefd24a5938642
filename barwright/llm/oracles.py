"""The text queries that SQL can express, for an independent engine."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PLAIN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACED = r"[^\x20\x09-\x0D]+"


def words(text: str, kept: str) -> str:
    """The words of a text column, A-Z lower-cased."""
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), '{kept}')"


DECONTAMINATE = f"""WITH d AS (SELECT doc_id, {words("text", PLAIN)} AS w FROM documents),
b AS (SELECT cast(item_id AS varchar) AS item, {words("text", PLAIN)} AS w FROM benchmark),
patterns AS (SELECT item, n, array_to_string(w[i:i + n - 1], ' ') AS key
  FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM (SELECT item, w, least(13, len(w)) AS n FROM b WHERE len(w) > 0))),
windows AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS key
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM patterns) WHERE len(w) >= n)),
found AS (SELECT doc_id, i, n, item FROM windows JOIN patterns USING (n, key)),
hits AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT d.doc_id, cast(len(w) AS bigint) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)"""
JACCARD_JOIN = f"""WITH RECURSIVE d AS (SELECT doc_id, {words("text", SPACED)} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + n - 1], ' ') AS key
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM (SELECT doc_id, w, least(4, len(w)) AS n FROM d WHERE len(w) > 0))),
sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM s a JOIN s b ON a.key = b.key AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared.n >= 85 * (x.n + y.n - shared.n)),
reach AS (SELECT doc_id AS node, doc_id AS other FROM d UNION SELECT node, b FROM reach JOIN links ON a = other)
SELECT d.doc_id, coalesce(sizes.n, 0) AS n_shingles, least_id AS component_id
FROM d LEFT JOIN sizes USING (doc_id) JOIN (SELECT node, min(other) AS least_id FROM reach GROUP BY node) r ON r.node = d.doc_id"""
