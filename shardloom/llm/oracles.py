"""DuckDB SQL for the queries that SQL can express as a whole."""

from __future__ import annotations

from . import jaccard, line_dedup, quality

SPACE = r"[\x20\x09-\x0D]+"
LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{SPACE}'), lambda x: x <> '')"


JACCARD = f"""WITH RECURSIVE d AS (SELECT doc_id, {words(LOWER.format("coalesce(text, '')"))} AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {jaccard.SHINGLE} THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - {jaccard.SHINGLE - 2}), lambda p: array_to_string(w[p:p + {jaccard.SHINGLE - 1}], ' '))) END AS s FROM d),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS k FROM s),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.k = b.k AND a.doc_id <> b.doc_id AND 100 * a.n >= {jaccard.PERCENT} * b.n AND 100 * b.n >= {jaccard.PERCENT} * a.n GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {jaccard.PERCENT} * (a.n + b.n - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, c.component_id FROM s JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = s.doc_id"""

SUBSTRING = f"""WITH d AS (SELECT doc_id, {words("coalesce(text, '')")} AS w FROM documents),
win AS (SELECT doc_id, p, array_to_string(w[p:p + 19], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS p FROM d WHERE len(w) >= 20)),
later AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS r FROM win) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS q FROM later),
each AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS q FROM d),
kept AS (SELECT each.doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY each.q) AS t FROM each ANTI JOIN gone ON gone.doc_id = each.doc_id AND gone.q = each.q GROUP BY each.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(kept.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256 FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id"""

_TREE = f"""lines AS (SELECT doc_id, md5(t) AS digest, unnest(string_split(t, chr(10))) AS line, unnest(range(0, len(string_split(t, chr(10))))) AS place FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)),
masked AS (SELECT doc_id, digest, place, list_transform({words('line')}, lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '{line_dedup.FIELD}' ELSE x END) AS w FROM lines),
leafed AS (SELECT *, len(w) || '|' || array_to_string(w[1:{line_dedup.LEAD}], ' ') AS leaf FROM masked WHERE len(w) > 0),
cand AS (SELECT * FROM leafed WHERE leaf IN (SELECT leaf FROM leafed GROUP BY leaf HAVING count(DISTINCT digest) >= {line_dedup.MIN_DOCS})),
variants AS (SELECT leaf, w, count(DISTINCT digest) AS docs FROM cand GROUP BY leaf, w),
places AS (SELECT leaf, w, docs, unnest(w) AS t, unnest(range(0, len(w))) AS pos FROM variants),
support AS (SELECT leaf, pos, t, sum(docs) AS n FROM places GROUP BY leaf, pos, t),
shaped AS (SELECT p.leaf, p.w, any_value(p.docs) AS docs, string_agg(CASE WHEN n >= {line_dedup.MIN_DOCS} THEN p.t ELSE '{line_dedup.FIELD}' END, ' ' ORDER BY p.pos) AS template, avg(CASE WHEN n >= {line_dedup.MIN_DOCS} AND p.t <> '{line_dedup.FIELD}' THEN 1 ELSE 0 END) AS share FROM places p JOIN support s ON s.leaf = p.leaf AND s.pos = p.pos AND s.t = p.t GROUP BY p.leaf, p.w),
often AS (SELECT leaf, template FROM shaped WHERE share >= {line_dedup.CONSTANT} GROUP BY leaf, template HAVING sum(docs) >= {line_dedup.MIN_DOCS}),
hits AS (SELECT c.doc_id, c.place, row_number() OVER (PARTITION BY s.leaf, s.template ORDER BY c.doc_id, c.place) AS r FROM cand c JOIN shaped s ON s.leaf = c.leaf AND s.w = c.w JOIN often o ON o.leaf = s.leaf AND o.template = s.template),
gone AS (SELECT doc_id, place FROM hits WHERE r > 1)"""

LINES = f"""WITH {_TREE}, left_over AS (SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.place) AS text FROM lines l ANTI JOIN gone g ON g.doc_id = l.doc_id AND g.place = l.place GROUP BY l.doc_id),
n AS (SELECT l.doc_id, count(*) AS n_lines, count(g.place) AS n_dropped FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.place = l.place GROUP BY l.doc_id)
SELECT n.doc_id, coalesce(left_over.text, '') AS text, n_lines, n_dropped FROM n LEFT JOIN left_over ON left_over.doc_id = n.doc_id"""

_STRIP = r"^[.,;:!?\"''()]+|[.,;:!?\"''()]+$"
QUALITY = f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {words("coalesce(text, '')")} AS w, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM documents),
win AS (SELECT doc_id, p, w[p:p + 2] AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS p FROM d WHERE len(w) >= 3)),
again AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, k) AS n FROM win) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM again) GROUP BY doc_id),
tagged AS (SELECT d.doc_id, toxic, unnest(list_distinct(list_transform(list_transform(w, lambda x: {LOWER.format('x')}), lambda x: regexp_replace(x, '{_STRIP}', '', 'g')))) AS x FROM d JOIN labels ON labels.doc_id = d.doc_id WHERE toxic IS NOT NULL),
lexicon AS (SELECT x FROM tagged WHERE x <> '' GROUP BY x HAVING sum(toxic) >= greatest({quality.LEXICON_LEAST}, {quality.LEXICON_SHARE} * (SELECT sum(toxic) FROM labels)) AND sum(toxic) >= {quality.LEXICON_PRECISION} * count(*)),
marks AS (SELECT DISTINCT doc_id FROM (SELECT doc_id, unnest(list_transform(w, lambda x: regexp_replace({LOWER.format('x')}, '{_STRIP}', '', 'g'))) AS x FROM d) JOIN lexicon USING (x)),
f AS (SELECT d.doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines,
coalesce(rep.n, 0) AS n_repeat_words, length(t) - length(replace(t, '!', '')) AS shouts, marks.doc_id IS NOT NULL AS toxic FROM d LEFT JOIN rep ON rep.doc_id = d.doc_id LEFT JOIN marks ON marks.doc_id = d.doc_id)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > 3 * n_words OR 10 * shouts > 3 * n_words OR 10 * n_dup_lines > 4 * n_lines OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR toxic) AS kept FROM f"""

SQL = {"op2_quality_rules": QUALITY, "op5_ngram_jaccard_join": JACCARD, "op7_substring_dedup": SUBSTRING, "op8_line_dedup": LINES}
