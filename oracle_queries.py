"""SQL that DuckDB runs on the same tables, for every query with a deterministic result."""

from __future__ import annotations

from newsloom.plans.queries import ASKED_KEYWORD, ASKED_POSITION, KEYWORDS, PAIRS

_KEYWORD_TABLE = (
    "kw AS (SELECT * FROM (VALUES "
    + ", ".join(f"({i}, '{kw}')" for i, kw in enumerate(KEYWORDS))
    + ") AS t(kw_id, kw))"
)

_BENCHMARK_WORDS = r"""
words AS (
  SELECT item_id, kw FROM (
    SELECT item_id, unnest(regexp_split_to_array(text, '[^\p{L}]+')) AS kw FROM benchmark
  ) WHERE kw <> ''
)"""

_LEXICON_TABLE = f"""{_BENCHMARK_WORDS},
kw AS (
  SELECT CAST(row_number() OVER (ORDER BY first, kw) - 1 AS INTEGER) AS kw_id, kw
  FROM (SELECT kw, min(item_id) AS first FROM words GROUP BY kw)
)"""

_CORPORA = """
corpora AS (
  SELECT 'documents' AS corpus, doc_id AS id, CAST(0 AS BIGINT) AS part, text FROM documents
  UNION ALL SELECT 'pages', page_id, 0, html FROM pages
  UNION ALL SELECT 'conversations', conv_id, turn, text FROM conversations
  UNION ALL SELECT 'benchmark', item_id, 0, text FROM benchmark
)"""

# Keywords hold letters and spaces only, so they need no quoting in a pattern. The alternation
# lists the latest keyword first: it wins where several begin at the same place.
_PATTERN = "(SELECT string_agg(kw, '|' ORDER BY kw_id DESC) FROM kw)"

_HITS = """
hits AS (
  SELECT d.doc_id, k.kw_id, k.kw FROM documents d JOIN kw k ON contains(d.text, k.kw)
)"""

_EDGES = f"""{_HITS},
edges AS (
  SELECT a.kw_id, b.kw_id AS other_id, a.kw, b.kw AS other_kw, count(*) AS n
  FROM hits a JOIN hits b ON a.doc_id = b.doc_id AND a.kw_id <> b.kw_id
  GROUP BY ALL
)"""

_TOKENS = f"""
tok AS (
  SELECT doc_id, lang AS label, regexp_extract_all(text, {_PATTERN}) AS terms FROM documents
),
ex AS (SELECT doc_id, label, unnest(terms) AS term FROM tok),
idf AS (
  SELECT term, count(*) AS occurrences, (SELECT count(*) FROM tok) / count(*) AS idf
  FROM ex GROUP BY term
)"""

_WEIGHTS = """
counts AS (SELECT doc_id, label, term, count(*) AS n FROM ex GROUP BY ALL),
weights AS (
  SELECT c.doc_id, c.label, c.term,
         c.n / sum(c.n) OVER (PARTITION BY c.doc_id) * i.idf AS weight
  FROM counts c JOIN idf i USING (term)
)"""

_MODEL = f"""{_TOKENS}, {_WEIGHTS},
labels AS (
  SELECT CAST(row_number() OVER (ORDER BY min(doc_id)) - 1 AS INTEGER) AS label_id, label,
         count(*) AS n_docs,
         ln(count(*) + 1.0) - ln((SELECT count(*) FROM tok)
                                 + (SELECT count(DISTINCT label) FROM tok)) AS prior
  FROM tok GROUP BY label
),
sums AS (
  SELECT l.label_id, l.label, i.term, coalesce(sum(w.weight), 0) AS s
  FROM labels l CROSS JOIN idf i LEFT JOIN weights w ON w.label = l.label AND w.term = i.term
  GROUP BY ALL
),
model AS (
  SELECT label_id, label, term,
         ln(s + 1.0) - ln(sum(s) OVER (PARTITION BY label_id)
                          + (SELECT count(*) FROM idf)) AS theta
  FROM sums
)"""

# Scores of the texts in ``corpora``. Documents without known terms keep the prior.
_PREDICTED = f"""
new_tok AS (
  SELECT corpus, id, part, unnest(regexp_extract_all(text, {_PATTERN})) AS term FROM chosen
),
new_counts AS (
  SELECT t.corpus, t.id, t.part, t.term, count(*) AS n FROM new_tok t JOIN idf USING (term)
  GROUP BY ALL
),
new_weights AS (
  SELECT c.corpus, c.id, c.part, c.term,
         c.n / sum(c.n) OVER (PARTITION BY c.corpus, c.id, c.part) * i.idf AS weight
  FROM new_counts c JOIN idf i USING (term)
),
scores AS (
  SELECT w.corpus, w.id, w.part, m.label_id, sum(w.weight * m.theta) AS score
  FROM new_weights w JOIN model m USING (term) GROUP BY ALL
),
predicted AS (
  SELECT c.corpus, c.id, c.part,
         arg_max(l.label, (l.prior + coalesce(s.score, 0), -l.label_id)) AS label
  FROM chosen c CROSS JOIN labels l
  LEFT JOIN scores s ON s.corpus = c.corpus AND s.id = c.id AND s.part = c.part
                    AND s.label_id = l.label_id
  GROUP BY ALL
)"""

_MATRIX = """
cells AS (
  SELECT * FROM (
    SELECT vec_id AS "row", label, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS col,
           CAST(unnest(embedding) AS DOUBLE) AS value
    FROM embeddings
  )
),
a AS (SELECT "row", col, value FROM cells WHERE value <> 0),
b AS (SELECT col AS "row", label AS col, sum(value) AS value FROM cells GROUP BY ALL)"""

_PRODUCT = """
SELECT a."row", b.col, round(sum(a.value * b.value), 6) AS value
FROM a JOIN b ON a.col = b."row" GROUP BY ALL"""

_ONE_LINE = r"translate(text, chr(9) || chr(10) || chr(13), '   ')"

_SEGMENTED = f"""
spelt AS (
  SELECT doc_id, unnest(string_split({_ONE_LINE}, ' ')) AS word,
         generate_subscripts(string_split({_ONE_LINE}, ' '), 1) AS place
  FROM documents
),
known AS (SELECT word, count(*) AS n FROM spelt GROUP BY word HAVING count(*) >= 5)"""

_TAB_LINE = f"doc_id || chr(9) || lang || chr(9) || {_ONE_LINE}"


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",\n".join(part.strip() for part in parts) + "\n" + select.strip()


def _document_frequency(words: str) -> str:
    return _with(words, _HITS, select="SELECT count(*) AS n, kw FROM hits GROUP BY kw")


def _occurrences(words: str) -> str:
    return _with(
        words,
        _HITS,
        select="""
        SELECT h.doc_id, h.kw,
               CAST((length(d.text) - length(replace(d.text, h.kw, ''))) / length(h.kw)
                    AS BIGINT) AS n
        FROM hits h JOIN documents d USING (doc_id)""",
    )


def _cooccurrence(words: str) -> str:
    return _with(words, _EDGES, select="SELECT * FROM edges")


def _tokens(words: str) -> str:
    return _with(
        words,
        _TOKENS,
        select="""
        SELECT doc_id, CAST(len(terms) AS BIGINT) AS n_terms,
               array_to_string(terms, '|') AS terms
        FROM tok""",
    )


def _term_dictionary(words: str) -> str:
    return _with(
        words,
        _TOKENS,
        select="""
        SELECT CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS term_id, term FROM idf""",
    )


def _idf(words: str) -> str:
    return _with(
        words, _TOKENS, select="SELECT term, occurrences, round(idf, 9) AS idf FROM idf"
    )


def _tfidf(words: str) -> str:
    return _with(
        words,
        _TOKENS,
        _WEIGHTS,
        select="SELECT doc_id, term, round(weight, 9) AS weight FROM weights",
    )


def _nb_model(words: str) -> str:
    return _with(
        words, _MODEL, select="SELECT label_id, label, term, round(theta, 9) AS theta FROM model"
    )


def _predict(words: str, corpus: str, columns: str = "id, part, label") -> str:
    return _with(
        words,
        _MODEL,
        _CORPORA,
        f"chosen AS (SELECT * FROM corpora WHERE corpus = '{corpus}')",
        _PREDICTED,
        select=f"SELECT {columns} FROM predicted",
    )


def _new_weights(words: str) -> str:
    return _with(
        words,
        _TOKENS,
        f"""
        ntok AS (
          SELECT conv_id AS id, turn AS part,
                 unnest(regexp_extract_all(text, {_PATTERN})) AS term
          FROM conversations
        ),
        ncounts AS (
          SELECT t.id, t.part, t.term, count(*) AS n FROM ntok t JOIN idf USING (term)
          GROUP BY ALL
        )""",
        select="""
        SELECT c.id, c.part, c.term,
               round(c.n / sum(c.n) OVER (PARTITION BY c.id, c.part) * i.idf, 9) AS weight
        FROM ncounts c JOIN idf i USING (term)""",
    )


def _report(words: str) -> str:
    return _with(
        words,
        _EDGES,
        select="""
        SELECT k.kw_id, k.kw, count(e.other_kw) AS n_partners,
               coalesce(string_agg(e.other_kw || ':' || e.n, ',' ORDER BY e.n, e.other_kw), '')
                 AS partners
        FROM kw k LEFT JOIN edges e ON e.kw_id = k.kw_id GROUP BY k.kw_id, k.kw""",
    )


def _nearest(asked: str) -> str:
    """The ten nearest vectors of those asked for."""
    return f"""
        WITH asked AS ({asked}),
        pairs AS (
          SELECT q.vec_id AS word, v.vec_id AS neighbour,
                 list_cosine_similarity(CAST(q.embedding AS DOUBLE[]),
                                        CAST(v.embedding AS DOUBLE[])) AS similarity
          FROM asked q JOIN embeddings v ON v.vec_id <> q.vec_id
        )
        SELECT word, CAST(rank AS INTEGER) AS rank, neighbour,
               round(similarity, 9) AS similarity
        FROM (SELECT *, row_number() OVER (
                PARTITION BY word ORDER BY similarity DESC, neighbour) AS rank FROM pairs)
        WHERE rank <= 10"""


def _pair_counts() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{a}' AS kw, '{b}' AS other_kw, count(*) FILTER "
        f"(WHERE contains(text, '{a}') AND contains(text, '{b}')) AS n FROM documents"
        for a, b in PAIRS
    )


def all_oracles() -> dict[str, str]:
    keywords, lexicon = _KEYWORD_TABLE, _LEXICON_TABLE
    return {
        "keyword_doc_freq": _document_frequency(keywords),
        "lexicon_doc_freq": _document_frequency(lexicon),
        "joined_doc_freq": _document_frequency(lexicon),
        "keyword_occurrences": _occurrences(keywords),
        "lexicon_occurrences": _occurrences(lexicon),
        "joined_occurrences": _occurrences(lexicon),
        "pair_count": _pair_counts(),
        "docs_with_both": (
            f"SELECT doc_id FROM documents WHERE contains(text, '{PAIRS[0][0]}') "
            f"AND contains(text, '{PAIRS[0][1]}')"
        ),
        "cooccurrence": _cooccurrence(keywords),
        "lexicon_cooccurrence": _cooccurrence(lexicon),
        "joined_cooccurrence": _cooccurrence(lexicon),
        "cooccurrence_upper": _with(
            keywords, _EDGES, select="SELECT * FROM edges WHERE kw_id < other_id"
        ),
        "cooccurrence_lists": _with(
            keywords,
            _EDGES,
            select="""
            SELECT kw_id, CAST(sum(n) AS BIGINT) AS n_pairs,
                   string_agg(other_id || ':' || n, ',' ORDER BY other_id) AS neighbours
            FROM edges WHERE kw_id < other_id GROUP BY kw_id""",
        ),
        "adjacency_rows": _with(
            keywords,
            _EDGES,
            select="""
            SELECT kw_id, string_agg(CAST(other_id AS VARCHAR), ',' ORDER BY other_id) AS indices,
                   string_agg(CAST(n AS VARCHAR), ',' ORDER BY other_id) AS counts
            FROM edges WHERE kw_id < other_id GROUP BY kw_id""",
        ),
        "partner_count": _with(
            keywords,
            _EDGES,
            _BENCHMARK_WORDS,
            select="""
            SELECT q.kw, CASE WHEN k.kw IS NULL THEN -1
                              ELSE (SELECT count(*) FROM edges e WHERE e.kw = q.kw)
                         END AS n_partners
            FROM (SELECT DISTINCT kw FROM words) q LEFT JOIN kw k ON k.kw = q.kw""",
        ),
        "partners_of": _with(
            keywords,
            _EDGES,
            select=f"SELECT other_kw, n FROM edges WHERE kw = '{ASKED_KEYWORD}'",
        ),
        "partner_ids": _with(
            keywords, _EDGES, select=f"SELECT other_id, n FROM edges WHERE kw_id = {ASKED_POSITION}"
        ),
        "keyword_report": _report(keywords),
        "dictionary_index": _with(
            keywords,
            _BENCHMARK_WORDS,
            select="""
            SELECT q.kw, coalesce(k.kw_id, -1) AS kw_id
            FROM (SELECT DISTINCT kw FROM words) q LEFT JOIN kw k ON k.kw = q.kw""",
        ),
        "dictionary_keyword": _with(
            keywords,
            select="""
            SELECT CAST(e.vec_id AS INTEGER) AS kw_id, coalesce(k.kw, 'oops') AS kw
            FROM embeddings e LEFT JOIN kw k ON k.kw_id = e.vec_id""",
        ),
        "dictionary_size": _with(
            _BENCHMARK_WORDS, select="SELECT count(DISTINCT kw) AS n FROM words"
        ),
        "dict_tokens": _tokens(keywords),
        "lexicon_tokens": _tokens(lexicon),
        "joined_tokens": _tokens(lexicon),
        "term_dictionary": _term_dictionary(keywords),
        "lexicon_term_dictionary": _term_dictionary(lexicon),
        "label_dictionary": """
            SELECT CAST(row_number() OVER (ORDER BY min(doc_id)) - 1 AS INTEGER) AS label_id,
                   lang AS label
            FROM documents GROUP BY lang""",
        "custom_idf": _idf(keywords),
        "lexicon_idf": _idf(lexicon),
        "token_doc_ratio": _with(
            keywords,
            _TOKENS,
            select="""
            SELECT term, count(DISTINCT doc_id) AS n_docs,
                   round(count(DISTINCT doc_id) / (SELECT count(*) FROM tok), 9) AS ratio
            FROM ex GROUP BY term""",
        ),
        "tfidf": _tfidf(keywords),
        "lexicon_tfidf": _tfidf(lexicon),
        "tfidf_new_texts": _new_weights(lexicon),
        "tfidf_vectors": _with(
            keywords,
            _TOKENS,
            _WEIGHTS,
            """
            ids AS (
              SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS term_id
              FROM idf
            )""",
            select="""
            SELECT doc_id, term_id, round(weight, 9) AS weight FROM weights JOIN ids USING (term)""",
        ),
        "nb_model": _nb_model(keywords),
        "lexicon_nb_model": _nb_model(lexicon),
        "nb_priors": _with(
            keywords,
            _MODEL,
            select="SELECT label_id, label, n_docs, round(prior, 9) AS prior FROM labels",
        ),
        "nb_predict": _predict(keywords, "documents"),
        "lexicon_nb_predict": _predict(lexicon, "conversations"),
        "nb_predict_joined": _predict(lexicon, "conversations"),
        "nb_label_hist": _with(
            lexicon,
            _MODEL,
            _CORPORA,
            "chosen AS (SELECT * FROM corpora)",
            _PREDICTED,
            select="SELECT corpus, label, count(*) AS n FROM predicted GROUP BY corpus, label",
        ),
        "nb_predict_first": _with(
            lexicon,
            _MODEL,
            _CORPORA,
            "chosen AS (SELECT * FROM corpora WHERE corpus = 'pages' ORDER BY id LIMIT 1)",
            _PREDICTED,
            select="SELECT id, label FROM predicted",
        ),
        "model_roundtrip": _predict(keywords, "documents"),
        "hashing_tfidf": _with(
            keywords,
            _TOKENS,
            """
            dfs AS (SELECT term, count(DISTINCT doc_id) AS df FROM ex GROUP BY term),
            tf AS (SELECT doc_id, term, count(*) AS n FROM ex GROUP BY ALL)""",
            select="""
            SELECT t.doc_id, t.term,
                   round(t.n * ln(((SELECT count(*) FROM tok) + 1.0) / (d.df + 1.0)), 9) AS weight
            FROM tf t JOIN dfs d USING (term)""",
        ),
        "matmul": _with(_MATRIX, select=_PRODUCT),
        "row_matrix_multiply": _with(_MATRIX, select=_PRODUCT),
        "transpose": _with(_MATRIX, select='SELECT col AS "row", "row" AS col, value FROM a'),
        "matrix_shape": "SELECT count(*) AS n_rows, max(len(embedding)) AS n_cols FROM embeddings",
        "nearest_vectors": _nearest(
            "SELECT vec_id, embedding FROM embeddings "
            "WHERE vec_id IN (SELECT min(vec_id) FROM embeddings GROUP BY label)"
        ),
        "labelled_file": f"SELECT doc_id, lang AS label, {_ONE_LINE} AS text FROM documents",
        "document_file": _document_frequency(keywords),
        "dictionary_file": _with(lexicon, select="SELECT kw_id, kw FROM kw"),
        "segmented_file": f"""
            SELECT token, count(*) AS n FROM (
              SELECT unnest(string_split(rtrim({_ONE_LINE}, ' '), ' ')) AS token FROM documents
            ) GROUP BY token""",
        "path_scan": f"""
            SELECT '2008' || (doc_id % 12 + 1) AS month, count(*) AS n_lines,
                   CAST(sum(length({_TAB_LINE})) AS BIGINT) AS n_chars
            FROM documents WHERE doc_id % 12 + 1 >= 10 GROUP BY 1""",
        "whole_file_scan": """
            SELECT lang AS label, count(*) AS n_lines,
                   CAST(sum(length(text) + 1) AS BIGINT) AS n_chars
            FROM documents GROUP BY lang""",
        "month_keywords": _with(
            keywords,
            f"""
            hits AS (
              SELECT d.doc_id, k.kw FROM documents d JOIN kw k ON contains({_ONE_LINE}, k.kw)
              WHERE d.doc_id % 12 = 11
            )""",
            select="SELECT count(*) AS n, kw FROM hits GROUP BY kw",
        ),
        "classification_files": _with(
            _KEYWORD_TABLE.replace(f"({KEYWORDS.index('les des')}, 'les des'), ", ""),
            _MODEL.replace("FROM documents", "FROM one_line_documents"),
            _CORPORA,
            f"chosen AS (SELECT corpus, id, part, {_ONE_LINE} AS text FROM corpora WHERE corpus = 'conversations')",
            _PREDICTED,
            select="SELECT label, count(*) AS n FROM predicted GROUP BY label",
        ).replace("WITH ", f"WITH one_line_documents AS (SELECT doc_id, lang, {_ONE_LINE} AS text FROM documents),\n", 1),
        "edge_store": _cooccurrence(keywords),
        "saved_classifier": _predict(keywords, "conversations"),
        "saved_weights": _new_weights(keywords),
        "saved_partners": _report(keywords),
        "saved_synonyms": _nearest("SELECT vec_id, embedding FROM embeddings WHERE vec_id % 3 = 0"),
        "nearest_many": _nearest("SELECT vec_id, embedding FROM embeddings"),
        "word2vec_vocabulary": _with(
            _SEGMENTED,
            select="SELECT CAST(row_number() OVER (ORDER BY word) - 1 AS INTEGER) AS id, word, n FROM known",
        ),
        "word2vec_pairs": _with(
            _SEGMENTED,
            """
            placed AS (
              SELECT doc_id, word, row_number() OVER (PARTITION BY doc_id ORDER BY place) AS place
              FROM spelt JOIN known USING (word)
            ),
            near AS (
              SELECT a.word, b.word AS context, (6 - abs(a.place - b.place)) / 5 AS weight
              FROM placed a JOIN placed b
                ON a.doc_id = b.doc_id AND a.place <> b.place AND b.place BETWEEN a.place - 5 AND a.place + 5
            )""",
            select="""
            SELECT word, count(DISTINCT context) AS n_contexts, round(sum(weight), 6) AS weight
            FROM near GROUP BY word""",
        ),
        "gram_matrix": _with(
            _MATRIX,
            select="""
            SELECT x.col AS "row", y.col, round(sum(x.value * y.value), 6) AS value
            FROM a x JOIN a y ON x."row" = y."row" GROUP BY ALL""",
        ),
        "counts_sink": _document_frequency(keywords),
        "matrix_files": _with(
            _MATRIX,
            select="""
            SELECT b.col, round(sum(a.value * b.value), 4) AS total
            FROM a JOIN b ON a.col = b."row" GROUP BY b.col""",
        ),
    }
