"""The same queries in DuckDB's SQL, written from the rules rather than from the plans.

Each query names the common table expressions it needs; they are put before it in order.
"""

from __future__ import annotations

from broadsheet.functions.dph import F_MAX
from broadsheet.functions.porter import STEP_2, STEP_3, STEP_4
from broadsheet.functions.stopwords import ENGLISH, as_tokens

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_DIGITS = "0123456789"

# DuckDB's levenshtein counts bytes. The letters outside ASCII in the titles are mapped one
# to one to control characters, which no title holds, so that a letter is one byte.
_ACCENTED = "ÄÇÈÉÊÍÑÓÖÜßäçèéêíñóöü"
_CONTROL = "||".join(f"chr({code})" for code in [*range(1, 9), *range(14, 27)])


def _quoted(words) -> str:
    return ", ".join(f"'{word}'" for word in words)


_STOP = f"[{_quoted(as_tokens(ENGLISH))}]"
_RUNS = "|".join(letter * 4 for letter in _LETTERS + _DIGITS)


def _token_list(text: str) -> str:
    return f"""list_filter(
      regexp_extract_all(translate({text}, '{_UPPER}', '{_LETTERS}'), '[a-z0-9]+'),
      lambda t: length(t) <= 20 AND length(regexp_replace(t, '[^0-9]', '', 'g')) <= 4
                AND NOT regexp_matches(t, '{_RUNS}'))"""


def _without_stopwords(tokens: str) -> str:
    return f"list_filter({tokens}, lambda t: NOT list_contains({_STOP}, t))"


# Porter's paper; a leading y, a consonant, is written Y.
_C, _V = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"
_M0 = f"^({_C})?{_V}{_C}"
_M1 = f"^({_C})?{_V}{_C}({_V})?$"
_M2 = f"^({_C})?{_V}{_C}{_V}{_C}"
_CVC = f"^{_C}[aeiouy][^aeiouwxy]"
_DOUBLE = "|".join(c * 2 for c in "bcdfghjkmnpqrtvwx" + _DIGITS) + "|([^aeiouy]|[aeiou]y)yy"


def _cut(n: int | str, word: str = "w") -> str:
    return f"left({word}, length({word}) - {n})"


def _suffix(table) -> str:
    return f"regexp_extract(w, '({'|'.join(table)})$', 1)"


def _mapped(table: dict[str, str]) -> str:
    cases = " ".join(f"WHEN '{old}' THEN '{new}'" for old, new in table.items())
    return f"CASE s {cases} END"


def _replacing(table: dict[str, str]) -> str:
    return (
        f"CASE WHEN s <> '' AND regexp_matches({_cut('length(s)')}, '{_M0}') "
        f"THEN {_cut('length(s)')} || {_mapped(table)} ELSE w END"
    )


_PORTER = [
    "regexp_replace(token, '^y', 'Y')",
    f"""CASE WHEN w LIKE '%sses' OR w LIKE '%ies' THEN {_cut(2)}
             WHEN w LIKE '%ss' THEN w WHEN w LIKE '%s' THEN {_cut(1)} ELSE w END""",
    f"""CASE WHEN w LIKE '%eed'
               THEN CASE WHEN regexp_matches({_cut(3)}, '{_M0}') THEN {_cut(1)} ELSE w END
             WHEN regexp_matches(w, '[aeiouy].*(ed|ing)$')
               THEN regexp_replace(w, '(ed|ing)$', '#') ELSE w END""",
    f"""CASE WHEN w NOT LIKE '%#' THEN w
             WHEN regexp_matches(w, '(at|bl|iz|{_CVC})#$') THEN {_cut(1)} || 'e'
             WHEN regexp_matches(w, '({_DOUBLE})#$') THEN {_cut(2)} ELSE {_cut(1)} END""",
    f"CASE WHEN regexp_matches(w, '[aeiouy].*y$') THEN {_cut(1)} || 'i' ELSE w END",
    (STEP_2, _replacing(STEP_2)),
    (STEP_3, _replacing(STEP_3)),
    (STEP_4, f"""CASE WHEN s <> '' AND regexp_matches({_cut('length(s)')}, '{_M2}')
                       AND (s <> 'ion' OR regexp_matches({_cut(3)}, '[st]$'))
                      THEN {_cut('length(s)')} ELSE w END"""),
    f"""CASE WHEN w LIKE '%e' AND (regexp_matches({_cut(1)}, '{_M2}')
                 OR (regexp_matches({_cut(1)}, '{_M1}')
                     AND NOT regexp_matches({_cut(1)}, '{_CVC}$')))
             THEN {_cut(1)} ELSE w END""",
    f"CASE WHEN w LIKE '%ll' AND regexp_matches(w, '{_M2}') THEN {_cut(1)} ELSE w END",
    "CASE WHEN length(token) <= 2 THEN token ELSE regexp_replace(w, '^Y', 'y') END",
]


def _stems() -> str:
    query = "SELECT token, token AS w FROM vocabulary"
    for step in _PORTER:
        if isinstance(step, tuple):
            table, step = step
            query = f"SELECT token, w, {_suffix(table)} AS s FROM ({query})"
        query = f"SELECT token, {step} AS w FROM ({query})"
    return f"SELECT token, w AS stem FROM ({query})"


_DPH = f"""
    CASE WHEN corpus_tf > n_docs THEN 0.0 ELSE
      (1 - f) * (1 - f) / (tf + 1)
      * (tf * log2((tf * avg_length / length) * (n_docs // corpus_tf))
         + 0.5 * log2(2 * pi() * tf * (1 - f)))
    END"""

def _near(distance: float) -> str:
    longer = "greatest(a.n, x[1].n)"
    return f"""CASE WHEN abs(a.n - x[1].n) / {longer} >= {distance} THEN false
                ELSE levenshtein(a.t, x[1].t) / {longer} < {distance} END"""


def _taken(k: int, distance: float) -> str:
    return f"""
        SELECT query_id, list_reduce(
                 list_transform(c, lambda x: [x]),
                 lambda acc, x: CASE WHEN len(acc) >= {k} THEN acc
                   WHEN len(list_filter(acc, lambda a: {_near(distance)})) > 0 THEN acc
                   ELSE list_concat(acc, x) END) AS entries
        FROM candidates"""


_TABLES = {
    "articles": """
        SELECT doc_id, lang, source,
               CASE WHEN contains(text, chr(10)) THEN string_split(text, chr(10))[1] END AS title,
               CASE WHEN contains(text, chr(10)) THEN string_split(text, chr(10))[2:]
                    ELSE string_split(text, chr(10)) END AS items
        FROM documents""",
    "titled": """
        SELECT doc_id, title,
               list_filter(items, lambda i: length(i) >= 20)[1:5] AS paragraphs
        FROM articles WHERE title IS NOT NULL AND title <> ''""",
    "texts": """
        SELECT doc_id, title,
               array_to_string(list_prepend(title, paragraphs), ' ') AS index_text
        FROM titled""",
    "tokenized": f"SELECT doc_id, title, {_token_list('index_text')} AS tokens FROM texts",
    "docs": f"SELECT doc_id, title, {_without_stopwords('tokens')} AS tokens FROM tokenized",
    "queries": """
        SELECT min(item_id) AS query_id, replace(text, chr(10), ' ') AS original_query
        FROM benchmark GROUP BY original_query""",
    "query_docs": f"""
        SELECT query_id, {_without_stopwords(_token_list('original_query'))} AS tokens
        FROM queries""",
    "doc_tokens": """
        SELECT doc_id, len(tokens) AS length, unnest(tokens) AS token,
               generate_subscripts(tokens, 1) - 1 AS pos
        FROM docs""",
    "query_tokens": """
        SELECT query_id, unnest(tokens) AS token, generate_subscripts(tokens, 1) - 1 AS pos
        FROM query_docs""",
    "vocabulary": """
        SELECT token FROM doc_tokens UNION SELECT token FROM query_tokens""",
    "stems": _stems(),
    "query_positions": """
        SELECT query_id, pos, stem AS term FROM query_tokens JOIN stems USING (token)""",
    "query_terms": """
        SELECT query_id, term, count(*) AS qn,
               sum(count(*)) OVER (PARTITION BY query_id) AS n_terms
        FROM query_positions GROUP BY query_id, term""",
    "tf": """
        SELECT doc_id, length, stem AS term, count(*) AS tf
        FROM doc_tokens JOIN stems USING (token)
        WHERE stem IN (SELECT term FROM query_terms)
        GROUP BY doc_id, length, stem""",
    "corpus": """
        SELECT count(*) AS n_docs, CAST(sum(len(tokens)) AS BIGINT) AS total_length,
               avg(len(tokens)) AS avg_length
        FROM docs""",
    "corpus_tf": """
        SELECT q.term, CAST(coalesce(sum(tf), 0) AS BIGINT) AS corpus_tf
        FROM (SELECT DISTINCT term FROM query_terms) q LEFT JOIN tf ON tf.term = q.term
        GROUP BY q.term""",
    "term_scores": f"""
        SELECT doc_id, term, {_DPH} AS score
        FROM (SELECT *, CASE WHEN tf < length THEN tf / length ELSE {F_MAX} END AS f FROM tf)
             JOIN corpus_tf USING (term), corpus""",
    "scores": """
        SELECT query_id, doc_id, sum(qn * score) / n_terms AS score
        FROM term_scores JOIN query_terms USING (term)
        GROUP BY query_id, doc_id, n_terms HAVING sum(qn * score) <> 0""",
    "ranked": """
        SELECT query_id, doc_id, score,
               row_number() OVER (PARTITION BY query_id
                                  ORDER BY round(score, 9) DESC, doc_id) AS rank
        FROM scores""",
    "candidates": f"""
        SELECT query_id, list(struct_pack(doc_id := doc_id, score := score, n := length(title),
                 t := translate(title, '{_ACCENTED}', {_CONTROL})) ORDER BY rank) AS c
        FROM ranked JOIN titled USING (doc_id) GROUP BY query_id""",
    "taken": _taken(10, 0.5),
    "diverse": """
        SELECT query_id, rank, entry.doc_id AS doc_id, entry.score AS score
        FROM (SELECT query_id, unnest(entries) AS entry,
                     generate_subscripts(entries, 1) AS rank FROM taken)""",
}

# What each table reads; the rest follows.
_NEEDS = {
    "articles": [], "titled": ["articles"], "texts": ["titled"], "tokenized": ["texts"],
    "docs": ["tokenized"], "queries": [], "query_docs": ["queries"],
    "doc_tokens": ["docs"], "query_tokens": ["query_docs"],
    "vocabulary": ["doc_tokens", "query_tokens"], "stems": ["vocabulary"],
    "query_positions": ["stems"], "query_terms": ["query_positions"], "tf": ["query_terms"],
    "corpus": ["docs"], "corpus_tf": ["tf"], "term_scores": ["corpus_tf", "corpus"],
    "scores": ["term_scores"], "ranked": ["scores"], "candidates": ["ranked", "titled"],
    "taken": ["candidates"], "diverse": ["taken"],
}


def _sql(needs: list[str], select: str, **instead: str) -> str:
    """A query with the tables it needs, some of them defined otherwise ``instead``."""
    wanted: set[str] = set()

    def add(name: str) -> None:
        if name not in wanted:
            wanted.add(name)
            for other in _NEEDS[name]:
                add(other)

    for name in needs:
        add(name)
    parts = [f"{name} AS MATERIALIZED ({instead.get(name, _TABLES[name])})"
             for name in _TABLES if name in wanted]
    return (f"WITH {', '.join(parts)} " if parts else "") + select


ORACLES = {
    "scan_queries": _sql(["queries"], "SELECT original_query AS line FROM queries"),
    "scan_articles": _sql(
        ["articles"], "SELECT doc_id, CAST(length(title) AS INTEGER) AS n_chars FROM articles"
    ),
    "parse_articles": _sql(["articles"], """
        SELECT CAST(doc_id AS VARCHAR) AS id, title,
               CASE WHEN lang = 'en' THEN doc_id * 86400000 ELSE 0 END AS published_date,
               CAST(len(items) AS INTEGER) AS n_items,
               CAST(len(list_filter(items, lambda i: length(i) >= 20)) AS INTEGER)
                 AS n_paragraphs
        FROM articles"""),
    "bad_article_lines": _sql([], """
        SELECT CAST(doc_id AS VARCHAR) AS id, 'unknown field' AS problem, 'lang' AS unknown
        FROM documents WHERE lang <> 'en'"""),
    "sorted_article_lines": _sql(["articles"], """
        SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN lang = 'en' THEN 'article' ELSE 'unknown field' END AS kind,
               CASE WHEN lang = 'en' THEN CAST(len(items) AS INTEGER) ELSE 0 END AS n_items
        FROM articles"""),
    "parse_queries": _sql(["query_positions"], """
        SELECT query_id, CAST(pos AS INTEGER) AS pos, term, CAST(1 AS SMALLINT) AS cnt
        FROM query_positions"""),
    "tokenize": _sql(["tokenized"], """
        SELECT doc_id, CAST(generate_subscripts(tokens, 1) - 1 AS INTEGER) AS pos,
               unnest(tokens) AS token
        FROM tokenized"""),
    "remove_stopwords": _sql(
        ["doc_tokens"], "SELECT doc_id, CAST(pos AS INTEGER) AS pos, token FROM doc_tokens"
    ),
    "stem_vocabulary": _sql(["stems"], """
        SELECT token, stem FROM stems WHERE token IN (SELECT token FROM doc_tokens)"""),
    "text_to_terms": _sql(["stems"], """
        SELECT doc_id, CAST(pos AS INTEGER) AS pos, stem AS term
        FROM doc_tokens JOIN stems USING (token)"""),
    "articles_with_title": _sql(["titled"], "SELECT doc_id, title FROM titled"),
    "lead_paragraphs": _sql(["titled"], """
        SELECT doc_id, CAST(generate_subscripts(paragraphs, 1) - 1 AS INTEGER) AS pos,
               unnest(paragraphs) AS paragraph
        FROM titled"""),
    "index_text": _sql(["texts"], "SELECT doc_id, index_text FROM texts"),
    "article_stats": _sql(["tf", "titled"], """
        SELECT doc_id, title, CAST(length AS INTEGER) AS length, query_id,
               CAST(pos AS INTEGER) AS pos, tf
        FROM tf JOIN query_positions USING (term) JOIN titled USING (doc_id)"""),
    "document_length": _sql(
        ["docs"], "SELECT doc_id, CAST(len(tokens) AS INTEGER) AS length FROM docs"
    ),
    "term_frequency": _sql(["tf"], "SELECT doc_id, term, tf FROM tf"),
    "corpus_stats": _sql(["corpus"], "SELECT n_docs, total_length, avg_length FROM corpus"),
    "corpus_term_frequency": _sql(["corpus_tf"], "SELECT term, corpus_tf FROM corpus_tf"),
    "dph_term_score": _sql(
        ["term_scores"], "SELECT doc_id, term, round(score, 6) AS score FROM term_scores"
    ),
    "dph_query_score": _sql(
        ["scores"], "SELECT query_id, doc_id, round(score, 6) AS score FROM scores"
    ),
    "title_distance": _sql(["ranked", "titled"], f"""
        , top AS (
            SELECT query_id, rank, doc_id, length(title) AS n,
                   translate(title, '{_ACCENTED}', {_CONTROL}) AS t
            FROM ranked JOIN titled USING (doc_id) WHERE rank <= 10)
        SELECT a.query_id, CAST(a.rank AS INTEGER) AS rank, a.doc_id,
               round(levenshtein(a.t, b.t) / greatest(a.n, b.n), 6) AS distance
        FROM top a JOIN top b ON a.query_id = b.query_id AND b.rank = 1
        WHERE a.rank > 1"""),
    "rank_by_score": _sql(
        ["ranked"], "SELECT query_id, doc_id, CAST(rank AS BIGINT) AS rank FROM ranked"
    ),
    "top10_plain": _sql(["ranked"], """
        SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, round(score, 6) AS score
        FROM ranked WHERE rank <= 10"""),
    "top10_pruned": _sql(["ranked"], """
        SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, round(score, 6) AS score
        FROM ranked WHERE rank <= 10"""),
    "top2000_plain": _sql(["ranked"], """
        SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, round(score, 6) AS score
        FROM ranked WHERE rank <= 2000"""),
    "diverse_far_titles": _sql(["diverse"], """
        SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, round(score, 6) AS score
        FROM diverse""", taken=_taken(25, 0.9)),
    "top10_diverse": _sql(["diverse"], """
        SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, round(score, 6) AS score
        FROM diverse"""),
    "ranked_article_ids": _sql(["diverse"], "SELECT DISTINCT doc_id FROM diverse"),
    "ranked_articles": _sql(["diverse"], """
        SELECT doc_id, title FROM articles WHERE doc_id IN (SELECT doc_id FROM diverse)"""),
    "ranking_with_articles": _sql(["diverse"], """
        SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, title, 'article' AS type, source
        FROM diverse JOIN articles USING (doc_id)"""),
    "document_rankings": _sql(["diverse", "queries"], """
        SELECT q.query_id, CAST(count(d.doc_id) AS INTEGER) AS n_results,
               coalesce(string_agg(CAST(d.doc_id AS VARCHAR), ',' ORDER BY d.rank), '')
                 AS doc_ids
        FROM queries q LEFT JOIN diverse d ON d.query_id = q.query_id
        GROUP BY q.query_id"""),
    "word_rankings": _sql(["diverse", "queries"], """
        SELECT q.query_id AS word, CAST(count(d.doc_id) AS INTEGER) AS n_results,
               coalesce(string_agg(CAST(d.doc_id AS VARCHAR), ',' ORDER BY d.rank), '')
                 AS doc_ids
        FROM queries q LEFT JOIN diverse d ON d.query_id = q.query_id
        GROUP BY q.query_id""", queries=f"""
        SELECT DISTINCT word AS query_id, word AS original_query FROM (
          SELECT unnest(regexp_extract_all(
            translate(text, '{_UPPER}', '{_LETTERS}'), '[a-z0-9]+')) AS word FROM benchmark)"""),
    "written_rankings": _sql(["diverse", "queries"], """
        SELECT q.query_id, true AS names_query, CAST(count(d.doc_id) AS INTEGER) AS n_results
        FROM queries q LEFT JOIN diverse d ON d.query_id = q.query_id GROUP BY q.query_id"""),
    "ranking_text": _sql(["diverse", "queries"], """
        SELECT q.query_id, q.original_query || chr(10) || coalesce(string_agg(
                 '  ' || d.rank || ':' || d.doc_id || ' ' || printf('%.6f', round(d.score, 6))
                 || ' ' || a.title || chr(10), '' ORDER BY d.rank), '') AS body
        FROM queries q LEFT JOIN diverse d ON d.query_id = q.query_id
             LEFT JOIN articles a ON a.doc_id = d.doc_id
        GROUP BY q.query_id, q.original_query"""),
    "article_index": _sql(
        [], "SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS idx FROM documents"
    ),
    "index_partition": _sql([], """
        SELECT CAST(idx % 12 AS INTEGER) AS part, count(*) AS n_articles
        FROM (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS idx FROM documents)
        GROUP BY part"""),
}
