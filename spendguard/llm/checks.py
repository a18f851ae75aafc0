"""SQL (DuckDB) for the queries that it can express; the others have brute-force tests in tests/llm."""

from __future__ import annotations

from spendguard.llm.curriculum import KNOTS, MAX_REPEATS, WEIGHTS
from spendguard.llm.divergence import LEAST_DOCS, SCALE, TOP_TERMS
from spendguard.llm.licenses import BASE, COVERAGE, NOTICES, REACH
from spendguard.llm.queries import LISTED_HOSTS, URL_RULES

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _rules(part: int) -> str:
    ordered = sorted(URL_RULES, key=lambda r: (len(r[0] + r[1]), len(r[0])), reverse=True)
    cases = [
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{(h + p, v)[part]}'"
        for h, p, v in ordered
    ]
    return "CASE " + " ".join(cases) + " END"


OP1 = f"""
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS r FROM pages
), parsed AS (
  SELECT page_id,
    coalesce({_LOWER.format("regexp_extract(r, '^([^/?#]*)', 1)")}, '') AS host,
    coalesce(regexp_extract(r, '^[^/?#]*([^?#]*)', 1), '') AS path,
    list_sort(list_filter(string_split(coalesce(regexp_extract(r, '^[^?#]*\\?([^#]*)', 1), ''), '&'),
      lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref)(=|$)'))) AS kept
  FROM rest
), named AS (
  SELECT page_id, host, path,
    CASE WHEN regexp_replace(host, '^www\\.', '') <> '' THEN regexp_replace(host, '^www\\.', '')
      || regexp_replace(path, '/+$', '')
      || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END END AS canonical
  FROM parsed
), listed AS (
  SELECT DISTINCT canonical FROM named
  WHERE canonical IS NOT NULL AND regexp_matches(host, '(^|\\.)({"|".join(LISTED_HOSTS)})\\.')
)
SELECT n.page_id, host, path, {_rules(0)} AS rule,
  coalesce({_rules(1)}, CASE WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
  n.canonical, l.canonical IS NOT NULL AS listed
FROM named n LEFT JOIN listed l ON n.canonical = l.canonical
"""

_TEMPLATES = ", ".join(
    f"({i}, {i < len(BASE)}, '{phrase}', '{label}')" for i, (phrase, label) in enumerate([*BASE, *NOTICES])
)

OP4 = f"""
WITH templates AS (
  SELECT tid, base, label, string_split(phrase, ' ') AS t FROM (VALUES {_TEMPLATES}) AS v(tid, base, phrase, label)
), grams AS (
  SELECT tid, base, label, len(t) AS n, unnest(range(1, len(t))) AS q, t FROM templates
), cut AS (
  SELECT doc_id, list_filter(string_split_regex({_LOWER.format("coalesce(text, '')")},
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS w FROM documents
), here AS (
  SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS a, unnest(list_append(w[2:], NULL)) AS b FROM cut
), votes AS (
  SELECT doc_id, tid, base, label, n, p - q AS diagonal, bit_or(3::BIGINT << (q - 1)) AS mask
  FROM here JOIN grams ON a = t[q] AND b = t[q + 1] GROUP BY ALL
), merged AS (
  SELECT *, bit_or(mask) OVER (PARTITION BY doc_id, tid ORDER BY diagonal
    RANGE BETWEEN {REACH} PRECEDING AND {REACH} FOLLOWING) AS m FROM votes
), judged AS (
  SELECT doc_id, label, base AND mask = (1::BIGINT << n) - 1 AS placed, diagonal,
    NOT base AND bit_count(m)::DOUBLE / n >= {COVERAGE} AS verified, bit_count(m)::DOUBLE / n AS covered FROM merged
), found AS (
  SELECT doc_id, count(*) FILTER (placed) AS n_base, min(diagonal) FILTER (placed) AS first_word,
    max(diagonal) FILTER (placed) AS last_word,
    array_to_string(list_sort(list(DISTINCT label) FILTER (placed)), ',') AS base_labels,
    array_to_string(list_sort(list(DISTINCT label) FILTER (placed OR verified)), ',') AS labels,
    max(CASE WHEN placed THEN 1.0::DOUBLE WHEN verified THEN covered ELSE 0 END) AS score
  FROM judged GROUP BY doc_id
)
SELECT c.doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0::DOUBLE) AS score
FROM cut c LEFT JOIN found f ON c.doc_id = f.doc_id
"""


def _price(n: str, total: str) -> str:
    return f"1 + ({SCALE}::HUGEINT * ({n} + 1)) // ({total} + v)"


OP11 = f"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS found
  FROM documents
), said AS (
  SELECT d, lang, source, unnest(found) AS term FROM docs
), terms AS (
  SELECT lang, term, count(*) AS all_n FROM said GROUP BY ALL HAVING count(DISTINCT d) >= {LEAST_DOCS}
), langs AS (
  SELECT lang, count(*) AS v, sum(all_n)::HUGEINT AS all_total FROM terms GROUP BY lang
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM said SEMI JOIN terms USING (lang, term) GROUP BY ALL
), cells AS (
  SELECT g.lang, g.source, t.term, t.all_n, coalesce(c.n, 0) AS n,
    sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source)::HUGEINT AS total
  FROM groups g JOIN terms t USING (lang) LEFT JOIN counts c USING (lang, source, term)
), priced AS (
  SELECT lang, source, term, n, {_price("n", "total")} AS p, {_price("all_n", "all_total")} AS q
  FROM cells JOIN langs USING (lang)
), pairs AS (
  SELECT lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM priced a JOIN priced b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL
), rows AS (
  SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(value, 0) AS value
  FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
  LEFT JOIN pairs p ON p.lang = g.lang AND p.source = g.source AND p.item = h.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM priced WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM rows
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked
WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""

_WEIGHT = f"[{', '.join(map(str, WEIGHTS))}][(r - 1) % {len(WEIGHTS)} + 1]"
_LINES = " ".join(f"WHEN {w} THEN {[float(k) for k in line]}::DOUBLE[]" for w, line in KNOTS.items())

OP12 = f"""
WITH docs AS (
  SELECT doc_id, source, md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS key,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    row_number() OVER (ORDER BY source NULLS LAST) AS r FROM docs GROUP BY source
), weighed AS (
  SELECT source, source_size, {_WEIGHT} AS w, sum(source_size) OVER () AS total FROM sources
), filled AS (
  SELECT total - coalesce(sum({MAX_REPEATS} * source_size) OVER least, 0) AS above, sum(w) OVER () - coalesce(sum(w) OVER least, 0) AS below
  FROM weighed WINDOW least AS (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT arg_max(struct_pack(above, below), above / below) AS l FROM filled
), mixed AS (
  SELECT source, source_size, CASE w {_LINES} END AS k,
    least((w * l.above)::DOUBLE / l.below::DOUBLE, ({MAX_REPEATS} * source_size)::DOUBLE) AS target
  FROM weighed, level
), placed AS (
  SELECT doc_id, size, source_size, target, floor(target)::BIGINT AS stop, k,
    [0, (k[1] + k[2]) / 2, (k[1] + k[2]) / 2 + (k[2] + k[3]) / 2] AS areas,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM docs d JOIN mixed m ON d.source IS NOT DISTINCT FROM m.source
), sought AS (
  SELECT *, before::DOUBLE / target * areas[3] AS y,
    list_filter(range(0, {MAX_REPEATS}), lambda c: before + c * source_size < stop) AS copies FROM placed
), stepped AS (
  SELECT *, CASE WHEN areas[2] <= y THEN 1 ELSE 0 END AS step FROM sought
), timed AS (
  SELECT *, y - areas[step + 1] AS rest, k[step + 1] AS b, k[step + 2] AS e FROM stepped
)
SELECT doc_id, size, source_size, target,
  coalesce(list_sum(list_transform(copies, lambda c: least(size, stop - before - c * source_size))), 0)::BIGINT AS taken,
  len(copies)::INTEGER AS n_copies,
  CASE WHEN len(copies) > 0 THEN
    (step + CASE WHEN rest <= 0 THEN 0 ELSE rest * 2.0::DOUBLE / (b + sqrt(b * b + (e - b) * 2.0::DOUBLE * rest)) END) / 2
  END AS first_position
FROM timed
"""

CHECKS = {
    "op1_url_filters": OP1,
    "op4_license_scan": OP4,
    "op11_source_divergence": OP11,
    "op12_curriculum_mix": OP12,
}
