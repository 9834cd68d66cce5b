"""DuckDB SQL for the queries that SQL can express."""

from .licence_texts import KNOWN, SPELLINGS

_LINE_DEDUP = r"""
WITH line AS (
    SELECT doc_id, i AS raw, x AS line, trim(x, E' \t\r') AS trimmed
    FROM (SELECT doc_id, unnest(string_split(text, E'\n')) AS x, generate_subscripts(string_split(text, E'\n'), 1) AS i
          FROM documents WHERE text IS NOT NULL)
), filled AS (
    SELECT doc_id, raw, trimmed, row_number() OVER (PARTITION BY doc_id ORDER BY raw) AS pos
    FROM line WHERE trimmed <> ''
), win AS (
    SELECT doc_id, pos, trimmed AS a, lead(trimmed) OVER w AS b, lead(trimmed, 2) OVER w AS c
    FROM filled WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
), later AS (
    SELECT doc_id, pos FROM (
        SELECT doc_id, pos, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, pos) AS nth FROM win WHERE c IS NOT NULL
    ) WHERE nth > 1
), gone AS (
    SELECT DISTINCT f.doc_id, f.raw
    FROM (SELECT doc_id, pos + k AS pos FROM later, (VALUES (0), (1), (2)) AS v(k)) AS cover JOIN filled f USING (doc_id, pos)
), kept AS (
    SELECT l.doc_id, count(*) FILTER (l.trimmed <> '') AS n_lines, count(g.raw) AS n_removed,
           string_agg(CASE WHEN g.raw IS NULL THEN l.line END, E'\n' ORDER BY l.raw) AS text
    FROM line l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.raw = l.raw
    GROUP BY l.doc_id
)
SELECT d.doc_id, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed,
       CASE WHEN k.n_removed = k.n_lines AND k.n_removed > 0 THEN '' ELSE coalesce(k.text, d.text) END AS text
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""

_FILTER_AUDIT = r"""
WITH flag AS (
    SELECT doc_id, max(coalesce((quality = 1)::INT, 0)) AS good, max(coalesce((toxic = 1)::INT, 0)) AS toxic
    FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), doc AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
           min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least
    FROM documents
), cell AS (
    SELECT part,
           (len(words) < 200)::INT + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
           + 4 * (100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 2 * length(text))::INT
           + 8 * regexp_matches(text, '[#$%&*|]')::INT + 16 * coalesce(doc_id > least, false)::INT AS pattern,
           count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
    FROM doc LEFT JOIN flag USING (doc_id) GROUP BY ALL
), letter AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS t(name, bit)),
filter_order AS (
    SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
    FROM letter a, letter b, letter c, letter d, letter e
    WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31
), step AS (
    SELECT filter_order, step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS earlier
    FROM filter_order, (SELECT unnest([1, 2, 3, 4, 5])::INT AS step)
), counted AS (
    SELECT part, filter_order, step, own,
           coalesce(sum(n) FILTER (pattern & (own | earlier) = 0), 0) AS kept,
           coalesce(sum(n) FILTER (pattern & own > 0 AND pattern & earlier = 0), 0) AS removed,
           coalesce(sum(n) FILTER (pattern & own > 0 AND pattern & earlier > 0), 0) AS redundant,
           coalesce(sum(n) FILTER (pattern = own), 0) AS unique_fails,
           coalesce(sum(good) FILTER (pattern & own > 0 AND pattern & earlier = 0), 0) AS good_lost,
           coalesce(sum(toxic) FILTER (pattern & own > 0 AND pattern & earlier = 0), 0) AS toxic_lost
    FROM cell, step GROUP BY ALL
)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM counted
"""

_CANONICAL = """array_to_string(list_transform(
        list_filter(string_split(regexp_replace(lower(array_to_string(list_filter(string_split({0}, chr(10)),
            lambda x: NOT regexp_matches(lower(x), '^[ \\t]*(copyright\\b|\\(c\\)|©|all rights reserved)')), ' ')),
            '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' '), lambda w: w <> ''),
        lambda w: coalesce({1}[w], w)), ' ')"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_SPELLINGS = "MAP {" + ", ".join(f"{_quoted(a)}: {_quoted(b)}" for a, b in SPELLINGS.items()) + "}"
_LICENCES = f"""
WITH known AS (
    SELECT DISTINCT licence, {_CANONICAL.format("text", _SPELLINGS)} AS form
    FROM (VALUES {", ".join(f"({_quoted(a)}, {_quoted(b)})" for a, b in KNOWN)}) AS t(licence, text)
), unit AS (
    SELECT doc_id, true AS whole, {_CANONICAL.format("text", _SPELLINGS)} AS form FROM documents
    UNION ALL
    SELECT doc_id, false, {_CANONICAL.format("line", _SPELLINGS)} FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
), found AS (SELECT doc_id, whole, licence FROM unit JOIN known USING (form))
SELECT d.doc_id, coalesce(string_agg(DISTINCT f.licence, ',' ORDER BY f.licence) FILTER (f.whole), '') AS whole,
       coalesce(string_agg(DISTINCT f.licence, ',' ORDER BY f.licence) FILTER (NOT f.whole), '') AS notices
FROM documents d LEFT JOIN found f ON f.doc_id = d.doc_id
GROUP BY d.doc_id
"""

_DECONTAMINATE = r"""
WITH tokens AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
    FROM documents
), items AS (
    SELECT CAST(item_id AS VARCHAR) AS item, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
    FROM benchmark
), phrase AS (
    SELECT DISTINCT item, w[i:i + 9] AS p, len(w[i:i + 9]) AS n
    FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)
), lens AS (SELECT DISTINCT n FROM phrase
), place AS (
    SELECT doc_id, n, i, w[i:i + n - 1] AS p
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM tokens, lens WHERE len(w) >= n)
), found AS (
    SELECT doc_id, i, place.n AS n, item FROM place JOIN phrase USING (p)
), hit AS (
    SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM found) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM found GROUP BY doc_id
)
SELECT t.doc_id, CAST(len(t.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(n.n_items, 0) AS n_items,
       sha256(coalesce(n.names, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM tokens t LEFT JOIN hit h USING (doc_id) LEFT JOIN named n USING (doc_id)
"""

SQL: dict[str, str] = {
    "op5_licences": _LICENCES, "op7_decontaminate": _DECONTAMINATE, "op9_line_dedup": _LINE_DEDUP, "op11_filter_audit": _FILTER_AUDIT}
