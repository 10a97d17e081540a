"""DuckDB twins of the text queries that SQL can express."""

from __future__ import annotations


def line_dedup(docs: str, keep: str) -> str:
    """Runs of equal lines as islands of pairs of an earlier and a later line."""
    return f"""
WITH docs AS (SELECT * FROM {docs}),
lines AS (
  SELECT doc_id, CAST(unnest(range(len(l))) AS INTEGER) AS n, unnest(l) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM docs)
),
pairs AS (
  SELECT x.doc_id AS d1, y.doc_id AS d2, y.n - x.n AS shift, y.n AS n, length(y.line) AS chars
  FROM lines x JOIN lines y ON x.line = y.line AND (x.doc_id, x.n) < (y.doc_id, y.n)
),
islands AS (
  SELECT *, n - row_number() OVER (PARTITION BY d1, d2, shift ORDER BY n) AS island FROM pairs
),
runs AS (
  SELECT d2, min(n) AS lo, max(n) AS hi FROM islands GROUP BY d1, d2, shift, island HAVING sum(chars) >= 40
),
gone AS (SELECT DISTINCT d2 AS doc_id, unnest(range(lo, hi + 1)) AS n FROM runs),
spans AS (
  SELECT doc_id, count(*) AS n_deleted, count(*) FILTER (WHERE fresh) AS n_runs
  FROM (SELECT doc_id, n, coalesce(lag(n) OVER (PARTITION BY doc_id ORDER BY n) <> n - 1, true) AS fresh FROM gone)
  GROUP BY doc_id
),
kept AS (
  SELECT l.doc_id, count(*) AS n_lines,
    coalesce(string_agg(l.line, chr(10) ORDER BY l.n) FILTER (WHERE g.n IS NULL), '') AS text
  FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.n = g.n GROUP BY l.doc_id
)
{keep}"""


def shingle_groups(width: int, result: str) -> str:
    """Components of documents whose sets of ``width``-word shingles are alike by 0.8, from all pairs that share one."""
    return f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'
  ), lambda x: x <> '') AS w FROM documents
),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {width} THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - {width} + 2), lambda i: array_to_string(w[i : i + {width - 1}], ' '))) END AS s
  FROM words
),
shown AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM shown x JOIN shown y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
  GROUP BY ALL HAVING 100 * count(*) >= 80 * (any_value(x.n) + any_value(y.n) - count(*))
),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT sets.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(least(sets.doc_id, b), sets.doc_id) AS component_id{result}
FROM sets LEFT JOIN least ON sets.doc_id = least.a"""


def _terms(key: str, table: str) -> str:
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""SELECT {key}, term, count(*) AS tf FROM (
    SELECT {key}, unnest(regexp_extract_all({lower}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM {table}) GROUP BY ALL"""


RANKED = f"""
WITH tf AS ({_terms("doc_id", "documents")}),
sizes AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, totals GROUP BY term, docs
),
lengths AS (SELECT doc_id, 25 + (75 * n * docs) // terms AS m FROM sizes, totals),
scores AS (
  SELECT q.item_id, d.doc_id, CAST(sum(q.tf * w * ((1000000000 * d.tf) // (1000 * d.tf + 8 * m))) AS BIGINT) AS score
  FROM ({_terms("item_id", "benchmark")}) q JOIN tf d ON q.term = d.term JOIN weights ON weights.term = d.term
    JOIN lengths ON lengths.doc_id = d.doc_id
  GROUP BY ALL
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0
) WHERE rank <= 10"""


UNITS = (
    "mm|cm|m|km|inch|inches|feet|foot|yard|yards|mile|miles|mg|g|kg|ton|tons|ml|l|liter|liters|litre|litres|"
    "s|sec|second|seconds|min|minute|minutes|h|hour|hours|day|days|week|weeks|month|months|year|years|"
    "dollar|dollars|cent|cents|euro|euros|pound|pounds|percent|degrees"
)


def _tokens(text: str, names: bool) -> str:
    text = f"coalesce({text}, '')"
    text = f"lower(upper({text}))" if not names else f"regexp_replace({text}, '([\\p{{L}},;:] )(\\p{{Lu}}\\p{{L}}*(?: \\p{{Lu}}\\p{{L}}*)*)', '\\1⟨p \\2⟩', 'g')"
    text = f"regexp_replace({text}, '[0-9]+(?:[.,:/][0-9]+)*', '⟨n \\0⟩', 'g')"
    text = f"regexp_replace({text}, '(⟨n [^⟩]*⟩) ?({UNITS})\\b', '\\1⟨u \\2⟩', 'g')"
    text = f"regexp_replace({text}, '([$€£])(⟨n )', '⟨u \\1⟩\\2', 'g')"
    return f"regexp_extract_all({text}, '⟨[^⟩]*⟩|[\\p{{L}}\\p{{M}}]+')"


def _windows(key: str, table: str, names: bool) -> str:
    return f"""
  SELECT {key}, i AS at, array_to_string(canon[i + 1 : i + 8], ' ') AS h,
    list_filter(t[i + 1 : i + 8], lambda x: x LIKE '⟨%') AS slots
  FROM (SELECT {key}, t, canon, unnest(range(len(t) - 7)) AS i FROM (
    SELECT {key}, t, list_transform(t, lambda x: CASE WHEN x LIKE '⟨%' THEN x[1:2] ELSE lower(x) END) AS canon
    FROM (SELECT {key}, {_tokens("text", names)} AS t FROM {table}) WHERE len(t) >= 8))"""


def _search(names: bool) -> str:
    """CTEs of one search, with ``n`` or ``c`` (without case) behind their names."""
    s = "n" if names else "c"
    at = "doc_id, item_id, shift"
    return f"""
d{s} AS ({_windows("doc_id", "docs", names)}),
b{s} AS ({_windows("item_id", "benchmark", names)}),
hits{s} AS (
  SELECT d.doc_id, b.item_id, b.at AS item_at, d.at - b.at AS shift, b.slots AS s1, d.slots AS s2 FROM d{s} d JOIN b{s} b ON d.h = b.h
),
slots{s} AS (SELECT DISTINCT {at}, item_at, unnest(s1) AS v1, unnest(s2) AS v2 FROM hits{s}),
often{s} AS (SELECT {at}, v1, v2, count(*) AS k FROM slots{s} GROUP BY ALL),
stands{s} AS (
  SELECT {at}, v1, v2 AS v FROM often{s}
  QUALIFY row_number() OVER (PARTITION BY {at}, v1 ORDER BY k DESC, v2 <> v1, v2) = 1
),
bad{s} AS (SELECT DISTINCT {at}, item_at FROM slots{s} JOIN stands{s} USING ({at}, v1) WHERE v2 <> v1 AND v2 <> v),
changed{s} AS (SELECT DISTINCT {at}, true AS changed FROM slots{s} WHERE v1 <> v2),
good{s} AS (
  SELECT {at}, item_at, changed IS NULL AS exact FROM hits{s} ANTI JOIN bad{s} USING ({at}, item_at) LEFT JOIN changed{s} USING ({at})
),
found{s} AS (
  SELECT doc_id, item_id, bool_or(exact) AS exact FROM good{s} GROUP BY doc_id, item_id
  HAVING count(DISTINCT item_at) >= 0.25 * (SELECT count(*) FROM b{s} b WHERE b.item_id = good{s}.item_id)
)"""


def leaks(docs: str, keep: str) -> str:
    """Template windows compared as texts instead of hashes, with names and without case."""
    return f"""
WITH docs AS (SELECT * FROM {docs}),{_search(True)},{_search(False)},
found AS (
  SELECT doc_id, item_id, coalesce(n.exact, c.exact) AS exact FROM foundn n FULL JOIN foundc c USING (doc_id, item_id)
)
{keep}"""


# Kind, pattern, check of a value ``v``, own score, context words, does it always stay.
KINDS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true", 0.9, "mail|contact|write to", True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
     "list_bool_and(list_transform(string_split(v, '.'), lambda p: length(ltrim(p, '0')) < 3 OR (length(ltrim(p, '0')) = 3 AND ltrim(p, '0') <= '255')))",
     0.6, "ip|host|server|address", True),
    ("card", r"[0-9]([\x20-]?[0-9])+",
     """length(regexp_replace(v, '[^0-9]', '', 'g')) BETWEEN 13 AND 19 AND list_sum(list_transform(
        string_split(reverse(regexp_replace(v, '[^0-9]', '', 'g')), ''),
        lambda c, i: CASE WHEN i % 2 = 1 THEN CAST(c AS INT) WHEN c > '4' THEN 2 * CAST(c AS INT) - 9 ELSE 2 * CAST(c AS INT) END)) % 10 = 0""",
     0.7, "card|visa|credit|payment", True),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "length(regexp_replace(v, '[^0-9]', '', 'g')) BETWEEN 9 AND 15", 0.6, "phone|tel|call|mobile|fax", True),
    ("iban", r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?",
     """list_reduce(list_prepend(0, list_transform(
        string_split(replace(v, ' ', '')[5:] || replace(v, ' ', '')[1:4], ''),
        lambda c: CAST(CASE WHEN c BETWEEN '0' AND '9' THEN ascii(c) - 48 ELSE ascii(c) - 55 END AS BIGINT))),
        lambda a, x: (a * (CASE WHEN x > 9 THEN 100 ELSE 10 END) + x) % 97) = 1""",
     0.7, "iban|account|bank", False),
    ("ssn", "[0-9]{3}-[0-9]{2}-[0-9]{4}", "NOT regexp_matches(v, '^(?:000|666|9)')", 0.3, "ssn|social security|tax id|national id", False),
]


def personal() -> str:
    """Matches by splitting, starts by running sums of lengths."""
    parts = []
    for n, (kind, pattern, check, score, context, base) in enumerate(KINDS):
        alone = "true" if base else "NOT regexp_matches(before || after, '[A-Za-z0-9]')"
        keep = "true" if base else f"CASE WHEN regexp_matches(lead, '{context}') THEN {score} + 0.4 ELSE {score} END >= 0.5"
        parts.append(f"""
SELECT doc_id, {n} AS rank, '{kind}' AS kind, s AS start, s + length(v) AS stop, {str(base).lower()} AS base FROM (
  SELECT doc_id, v, s, CASE WHEN s > 0 THEN substring(t, s, 1) ELSE '' END AS before, substring(t, s + length(v) + 1, 1) AS after,
    lower(substring(t, greatest(s - 40, 0) + 1, least(s, 40))) AS lead
  FROM (
    SELECT doc_id, t, m[i] AS v, CAST(coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0)
      + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS INT) AS s
    FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (
      SELECT doc_id, t, regexp_extract_all(t, '{pattern}') AS m, string_split_regex(t, '{pattern}') AS g FROM docs)))
  WHERE {check})
WHERE {alone} AND {keep}""")
    label = "kind || ':' || start || ':' || stop"
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
spans AS ({" UNION ALL ".join(parts)})
SELECT d.doc_id,
  count(*) FILTER (WHERE kind = 'email') AS n_email, count(*) FILTER (WHERE kind = 'ip') AS n_ip,
  count(*) FILTER (WHERE kind = 'card') AS n_card, count(*) FILTER (WHERE kind = 'phone') AS n_phone,
  sha256(coalesce(string_agg({label}, ',' ORDER BY rank, start) FILTER (WHERE base), '')) AS base_sha256,
  coalesce(string_agg({label}, ',' ORDER BY rank, start), '') AS spans
FROM docs d LEFT JOIN spans s ON d.doc_id = s.doc_id GROUP BY d.doc_id"""


TWINS: dict[str, str] = {
    "op12_ranked_search": RANKED,
    "op7_ngram_jaccard": shingle_groups(5, ""),
    "op13_minhash": shingle_groups(4, ", sets.doc_id <= coalesce(b, sets.doc_id) AS kept"),
    "op2_line_dedup": line_dedup(
        "documents",
        """SELECT k.doc_id, k.n_lines, coalesce(s.n_deleted, 0) AS n_deleted, coalesce(s.n_runs, 0) AS n_runs,
  sha256(k.text) AS kept_sha256 FROM kept k LEFT JOIN spans s USING (doc_id)""",
    ),
    "op6_decontamination": leaks(
        "documents",
        """SELECT d.doc_id, count(f.item_id) AS n_items, count(*) FILTER (WHERE f.exact) AS n_exact,
  coalesce(string_agg(CAST(f.item_id AS VARCHAR), ',' ORDER BY f.item_id), '') AS items
FROM docs d LEFT JOIN found f ON d.doc_id = f.doc_id GROUP BY d.doc_id""",
    ),
    "op10_pii": personal(),
    "op3_url_lists": """
WITH p AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST(page_id * 7919 % 366 AS INT) AS fetched,
    lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#@]+)', 1)) AS host,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?[^/:?#@]+(?::[0-9]*)?(/[^/?#]+/)', 1) AS folder
  FROM pages
),
keys AS (
  SELECT DISTINCT 'domains' AS list, 'd:' || regexp_extract(host, '[^.]+[.][^.]+[.][^.]+$') AS key FROM p
  WHERE regexp_matches(host, '[^.]+[.][^.]+[.][^.]+$')
  UNION ALL SELECT DISTINCT 'folders', 'p:' || host || folder FROM p WHERE folder <> ''
),
entries AS (
  SELECT list, key, DATE '2024-01-01' + CAST(('0x' || md5(key)[i:i + 3])::INT % 366 AS INT) AS day, action
  FROM keys, (VALUES (1, 'add'), (5, 'remove'), (9, 'add')) t(i, action)
),
states AS (SELECT list, key, day, max(action) AS action FROM entries GROUP BY ALL),
state AS (
  SELECT p.page_id, s.list, s.key, arg_max(s.action, s.day) AS action FROM p JOIN states s ON s.day <= p.fetched
    AND (s.key = 'p:' || p.host || p.folder OR 'd:' || p.host = s.key OR ends_with(p.host, '.' || s.key[3:]))
  GROUP BY ALL
),
hits AS (SELECT page_id, string_agg(DISTINCT list, ',' ORDER BY list) AS lists FROM state WHERE action = 'add' GROUP BY page_id)
SELECT p.page_id, p.url, CAST(p.fetched AS VARCHAR) AS fetched, coalesce(h.lists, '') AS lists, h.lists IS NOT NULL AS blocked
FROM p LEFT JOIN hits h ON p.page_id = h.page_id""",
}
