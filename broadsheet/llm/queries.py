"""The operators of this subpackage as queries over the tables in a folder, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from broadsheet.llm import (
    debruijn, divergence, forest, minhash, mixing, packing, planes, ppm, quality, suffixes, topk,
    toxicity, variants,
)

TOKENIZER = "byte_bpe_50k.json"
WORD_TOKENIZER = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    """A public tokenizer of the queries, where it is installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_order(_table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return debruijn.remove_repeated_words(documents, with_text=False).drop("kept_text")


def op3_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path(), added_tokens=True)


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), words=2, percent=80)


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.removed_strings(_table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return toxicity.severities(documents, toxicity.train(documents, _table(spark, sf_dir, "labels")))


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = _table(spark, sf_dir, "embeddings")
    return topk.exact_top_k(embeddings.where("vec_id % 20 = 0"), embeddings, k=20)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = _table(spark, sf_dir, "embeddings")
    return forest.nearest(embeddings.where("vec_id % 100 = 0"), embeddings, k=10)


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score_texts(_table(spark, sf_dir, "documents"))


def op11_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planes.encode_documents(_table(spark, sf_dir, "documents"), tokenizer_path(WORD_TOKENIZER))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_mix_sources, op2_substring_dedup, op3_pack_sequences, op4_minhash_near_dedup,
    op5_suffix_array_dedup, op6_toxicity, op7_exact_top_k, op8_quality, op9_nearest_neighbours,
    op10_lm_scoring, op11_token_planes, op12_source_divergence, op13_spelling_variants,
)}

_WORDS = r"regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+')"
_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {
    "op2_substring_dedup": f"""
WITH words AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents),
windows AS (
  SELECT doc_id, i, sha256(array_to_string(list_slice(w, i, i + 19), ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 18, 1))) AS i FROM words)),
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (
    PARTITION BY h ORDER BY doc_id, i) AS n FROM windows) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM later),
single AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words),
kept AS (
  SELECT s.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY s.i) AS t
  FROM single s ANTI JOIN gone g ON s.doc_id = g.doc_id AND s.i = g.i GROUP BY s.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
  CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM words d LEFT JOIN kept k ON d.doc_id = k.doc_id""",
    "op4_minhash_near_dedup": f"""
WITH RECURSIVE words AS (SELECT doc_id, {_WORDS.format(_LOWERED)} AS w FROM documents),
shingles AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END) AS s
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.s = b.s
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  WHERE a.doc_id <> b.doc_id AND 100 * x.n >= 80 * y.n AND 100 * y.n >= 80 * x.n
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
reach AS (
  SELECT doc_id AS node, doc_id AS seen FROM sizes
  UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.seen),
least AS (SELECT node, min(seen) AS component FROM reach GROUP BY node)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component, w.doc_id) AS component_id,
  coalesce(component, w.doc_id) = w.doc_id AS kept
FROM words w LEFT JOIN sizes s ON w.doc_id = s.doc_id LEFT JOIN least l ON w.doc_id = l.node""",
    "op5_suffix_array_dedup": """
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
parts AS (  -- 500 windows each: to take a part of a long text costs its length
  SELECT doc_id, base, substr(x, 2 * base + 1, 1198) AS x
  FROM (SELECT doc_id, x, unnest(range(0, greatest(len(x) // 2 - 99, 0), 500)) AS base FROM docs)),
windows AS (
  SELECT doc_id, base + i AS i, md5(substr(x, 2 * i + 1, 200)) AS h
  FROM (SELECT doc_id, base, x, unnest(range(0, len(x) // 2 - 99)) AS i FROM parts)),
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS n FROM windows)
  WHERE n > 1),
marked AS (
  SELECT doc_id, i, CASE WHEN i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 1 ELSE 0 END AS fresh
  FROM later),
islands AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM marked),
spans AS (SELECT doc_id, g, min(i) AS a, max(i) + 100 AS b FROM islands GROUP BY doc_id, g),
after AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM spans),
kept AS (
  SELECT s.doc_id, string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS front,
    max(b) AS last, sum(b - a) AS removed, count(*) AS n
  FROM after s JOIN docs d ON d.doc_id = s.doc_id GROUP BY s.doc_id)
SELECT d.doc_id, CAST(len(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(front, '') || substr(x, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM docs d LEFT JOIN kept k ON d.doc_id = k.doc_id""",
    "op7_exact_top_k": """
WITH parts AS (
  SELECT vec_id, unnest(range(1, len(embedding) + 1)) AS i,
    CAST(floor(64 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x FROM embeddings),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM parts q JOIN parts c ON q.i = c.i
  WHERE q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id GROUP BY q.vec_id, c.vec_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM scores)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM ranked WHERE n <= 20""",
    "op12_source_divergence": r"""
WITH docs AS (SELECT row_number() OVER () AS id, coalesce(text, '') AS text, coalesce(lang, '') AS lang,
    coalesce(source, '') AS source FROM documents),
runs AS (SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS w FROM docs),
found AS (SELECT id, lang, source,
    translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM runs),
kept AS (SELECT lang, term, count(*) AS lang_n FROM found GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
counts AS (SELECT lang, source, term, count(*) AS n FROM found SEMI JOIN kept USING (lang, term) GROUP BY ALL),
langs AS (SELECT lang, count(*) AS v, sum(lang_n) AS total FROM kept GROUP BY lang),
totals AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY lang, source),
groups AS (SELECT g.lang, g.source, coalesce(l.v, 0)::HUGEINT AS v, coalesce(t.total, 0)::HUGEINT AS total,
    l.total::HUGEINT AS lang_total
  FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN langs l ON g.lang = l.lang
  LEFT JOIN totals t ON g.lang = t.lang AND g.source = t.source),
shares AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000 * (coalesce(c.n, 0)::HUGEINT + 5)) // (g.total + 5 * g.v) AS p,
    1 + (1000000000 * (k.lang_n::HUGEINT + 5)) // (g.lang_total + 5 * g.v) AS q
  FROM groups g JOIN kept k ON g.lang = k.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
apart AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
items AS (SELECT * FROM pairs UNION ALL
  SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r FROM items)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(r AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR r <= 50""",
    "op13_spelling_variants": r"""
WITH RECURSIVE found AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')) AS w FROM documents),
runs AS (
  SELECT doc_id, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS n
  FROM found WHERE length(w) >= 7 GROUP BY ALL),
steps AS (
  SELECT list(list_reduce([i, 0, 1, 2, 3, 4, 5, 6, 7], lambda c, k: CASE WHEN c & 1 = 1
    THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(0, 256))::BIGINT AS i)),
hashed AS (
  SELECT w, n, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, length(x) // 2),
      lambda i: ('0x' || x[2 * i + 1:2 * i + 2])::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM (SELECT w, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || w)) AS x FROM runs), steps),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN substring(w, 1, CAST(h % length(w) AS BIGINT))
      || substring(w, CAST(h % length(w) AS BIGINT) + 2) ELSE w END AS word, n FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cut AS (
  SELECT word, n, i, left(word, i - 1) AS a, substring(word, i + 1) AS b
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
shorter AS (SELECT DISTINCT c.word AS long, w.word AS short FROM cut c JOIN words w ON w.word = c.a || c.b),
near AS (
  SELECT x.word, y.word AS other FROM cut x JOIN cut y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION ALL SELECT long, short FROM shorter UNION ALL SELECT short, long FROM shorter),
best AS (
  SELECT near.word, count(*) AS n_near, arg_min({'form': o.word, 'n': o.n}, {'a': -o.n, 'b': o.word}) AS best
  FROM near JOIN words o ON o.word = near.other GROUP BY near.word),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN best.n >= 10 * w.n THEN best.form END AS form, CASE WHEN best.n >= 10 * w.n THEN best.n END AS form_n
  FROM words w LEFT JOIN best ON best.word = w.word),
chain AS (
  SELECT word, word AS root FROM forms
  UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL),
roots AS (SELECT c.word, c.root FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NULL)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM forms f JOIN roots r ON r.word = f.word""",
}
