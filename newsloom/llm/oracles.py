"""SQL for the queries that SQL can express, run by DuckDB over the same tables."""

from __future__ import annotations

from newsloom.llm import host_rules as Q
from newsloom.llm import licenses as L
from newsloom.llm import site_lines as S
from newsloom.llm import urls as U
from newsloom.llm.queries import NEIGHBOURS, QUERY_EVERY

UPPER, LOWER = U.UPPER, U.LOWER
WORD = r"[^\x20\x09-\x0D]"


def _text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _values(rows: list[tuple]) -> str:
    cells = lambda row: ", ".join(_text(v) if v is None or isinstance(v, str) else str(v) for v in row)
    return "VALUES " + ", ".join(f"({cells(row)})" for row in rows)


def _license_scan() -> str:
    grams = [
        (number, t.label, t.base, t.n, t.k, t.spread, len(t.grams()), i, gram)
        for number, t in enumerate(L.BASE + L.FUZZY)
        for i, gram in t.grams()
    ]
    return rf"""
    WITH t(template, label, base, n, k, spread, n_grams, t_pos, gram) AS ({_values(grams)}),
    words AS (
        SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
            translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM documents),
    places AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM words),
    grams AS (
        SELECT r, i - 1 AS pos, w[i] || ' ' || w[i + 1] AS gram FROM places WHERE i < len(w)
        UNION ALL
        SELECT r, i - 1, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FROM places WHERE i + 1 < len(w)),
    hits AS (SELECT *, pos - t_pos AS diagonal FROM grams JOIN t USING (gram)),
    exact AS (
        SELECT r, label, base, diagonal AS place, 1.0 AS score
        FROM hits WHERE spread = 0 GROUP BY r, template, label, base, n_grams, diagonal HAVING count(*) = n_grams),
    matched AS (
        SELECT DISTINCT r, template, label, n, t_pos + step AS word, pos + step AS here, unnest([
            floor(diagonal / spread), floor(diagonal / spread) - 1]) AS span
        FROM (SELECT *, unnest(range(k)) AS step FROM hits WHERE spread > 0)),
    spans AS (
        SELECT r, label, least(count(DISTINCT word), count(DISTINCT here))
            / greatest(n, max(here) - min(here) + 1) AS score
        FROM matched GROUP BY r, template, label, n, span),
    judged AS (
        SELECT * FROM exact
        UNION ALL SELECT r, label, false, NULL, score FROM spans WHERE score >= {L.MIN_COVERAGE}),
    found AS (
        SELECT r, count(*) FILTER (base) AS n_base, min(place) FILTER (base) AS first_word,
            max(place) FILTER (base) AS last_word,
            string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
            string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
        FROM judged GROUP BY r)
    SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
        coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
    FROM words LEFT JOIN found USING (r)
    """


def _url_filter() -> str:
    fits = []
    for rule in sorted(U.BASE, key=lambda r: (-len(r.name), r.pattern)):
        host, slash, path = rule.name.partition("/")
        fits.append(
            f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{slash}{path}') "
            f"THEN {_text(rule.name)}"
        )
    verdicts = " ".join(f"WHEN {_text(r.name)} THEN {_text(r.verdict)}" for r in U.BASE)
    own = " OR ".join(f"regexp_matches(host || '?' || path, {_text(r.pattern)})" for r in U.PATTERNS)
    return rf"""
    WITH cut AS (
        SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
        FROM pages),
    parts AS (
        SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
            regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
        FROM cut),
    ruled AS (SELECT *, CASE {' '.join(fits)} END AS rule FROM parts)
    SELECT page_id, host, path, rule,
        CASE rule {verdicts} ELSE CASE WHEN {own} THEN 'block' ELSE 'allow' END END AS verdict
    FROM ruled
    """


def _nearest_vectors() -> str:
    return f"""
    WITH v AS (
        SELECT vec_id, embedding::DOUBLE[] AS e,
            sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS norm
        FROM embeddings),
    pairs AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e) / (q.norm * c.norm) AS score
        FROM v q JOIN v c ON q.vec_id % {QUERY_EVERY} = 0 AND q.vec_id <> c.vec_id),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
    SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= {NEIGHBOURS}
    """


def _quality_rules() -> str:
    def own(stricter: int) -> str:
        above = lambda part, whole, percent: f"{100 * stricter} * {part} > {percent} * {whole}"
        return (
            f"({above('n_symbols', 'n_words', Q.MAX_SYMBOLS)} OR "
            f"{above('n_dup_lines', 'n_lines', Q.MAX_EQUAL_LINES)} OR "
            f"{above('n_capitals', 'word_chars', Q.MAX_CAPITALS)})"
        )

    return rf"""
    WITH cut AS (
        SELECT doc_id, source, coalesce(text, '') AS text,
            regexp_extract_all(coalesce(text, ''), '{WORD}+') AS w,
            list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS l
        FROM documents),
    windows AS (
        SELECT doc_id, i, list_slice(w, i, i + {Q.WINDOW - 1}) AS gram
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - {Q.WINDOW - 2})) AS i FROM cut)),
    again AS (SELECT doc_id, gram, list(i) AS places FROM windows GROUP BY ALL HAVING count(*) > 1),
    covered AS (
        SELECT doc_id, count(DISTINCT place + step) AS n_repeat_words
        FROM (SELECT doc_id, unnest(places) AS place FROM again), (SELECT unnest(range({Q.WINDOW})) AS step)
        GROUP BY doc_id),
    measured AS (
        SELECT doc_id, source, len(w) AS n_words, list_sum(list_transform(w, lambda x: length(x)))::BIGINT AS chars,
            len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
            len(regexp_extract_all(text, '[A-Z]')) AS n_capitals,
            len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
            coalesce(n_repeat_words, 0) AS n_repeat_words
        FROM cut LEFT JOIN covered USING (doc_id)),
    judged AS (
        SELECT * REPLACE (coalesce(chars, 0) AS chars), coalesce(chars, 0) AS word_chars,
            n_words < {Q.MIN_WORDS} OR 100 * n_repeat_words > {Q.MAX_REPEATED_PERCENT} * n_words AS base_failed
        FROM measured),
    hosts AS (
        SELECT source, count(*) AS n, count(*) FILTER (base_failed OR {own(1)}) AS failed FROM judged GROUP BY source),
    moments AS (SELECT avg(failed / n) AS mean, var_pop(failed / n) AS spread FROM hosts),
    prior AS (
        SELECT mean, CASE WHEN spread > 0 THEN greatest(1.0, mean * (1 - mean) / spread - 1) ELSE {Q.PLAIN_WEIGHT} END AS weight
        FROM moments),
    bad AS (
        SELECT source, (failed + mean * weight) / (n + weight) > {Q.MAX_HOST_RATE} AS bad FROM hosts, prior)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        NOT base_failed AND NOT CASE WHEN bad THEN {own(Q.STRICTER)} ELSE {own(1)} END AS kept
    FROM judged JOIN bad ON judged.source IS NOT DISTINCT FROM bad.source
    """


def _line_dedup() -> str:
    return rf"""
    WITH distinct_pages AS (SELECT DISTINCT source, text FROM documents WHERE text IS NOT NULL),
    totals AS (SELECT source, count(*) AS total FROM distinct_pages GROUP BY source),
    lines AS (
        SELECT DISTINCT source, text, unnest(string_split(text, chr(10))) AS line FROM distinct_pages),
    counts AS (
        SELECT source, line, count(*) AS n FROM lines WHERE regexp_matches(line, '{WORD}') GROUP BY source, line),
    dropped AS (
        SELECT counts.source, list(line) AS dropped
        FROM counts JOIN totals ON counts.source IS NOT DISTINCT FROM totals.source
        WHERE n >= {S.MIN_PAGES} AND n > total * {S.RATIO} GROUP BY counts.source),
    cut AS (
        SELECT doc_id, string_split(text, chr(10)) AS l,
            list_filter(string_split(text, chr(10)), lambda x: NOT list_contains(coalesce(dropped, []), x)) AS kept
        FROM documents LEFT JOIN dropped ON documents.source IS NOT DISTINCT FROM dropped.source)
    SELECT doc_id, coalesce(len(l), 0) AS n_lines, coalesce(len(l) - len(kept), 0) AS n_dropped,
        array_to_string(kept, chr(10)) AS text
    FROM cut
    """


def all_oracles() -> dict[str, str]:
    return {
        "op1_license_scan": _license_scan(),
        "op3_url_filter": _url_filter(),
        "op4_nearest_vectors": _nearest_vectors(),
        "op5_quality_rules": _quality_rules(),
        "op8_line_dedup": _line_dedup(),
    }
