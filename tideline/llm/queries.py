"""The registered queries of the corpus operators, with production parameters on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import (
    cover_search, lattice_links, page_wrappers, personal_data, phrase_mining, prefix_trie, rank_bpe, rule_quality,
    secret_models, simhash_index, suffix_radix, token_packing, warc_derivatives,
)
from tideline.llm.tables import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: SQL counterparts; the operators without one are tested against brute force.
SQL: dict[str, str] = {}

_USABLE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def query(make: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[make.__name__] = make
    return make


@query
def op1_suffix_dedup(spark, sf_dir):
    return suffix_radix.digests(load(spark, sf_dir, "documents"))


SQL["op1_suffix_dedup"] = """WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
),
sized AS (SELECT *, CAST(length(h) // 2 AS BIGINT) AS n_bytes FROM d),
-- Short blocks first: taking a string from far inside a long one reads all before it.
blocks AS (SELECT r, n_bytes, h, unnest(range((n_bytes + 499) // 500)) AS b FROM sized),
parts AS (SELECT r, b, least(500, n_bytes - 399 - 500 * b) AS n, substr(h, 1000 * b + 1, 1798) AS part FROM blocks),
starts AS (SELECT r, b, part, unnest(range(n)) AS j FROM parts WHERE n > 0),
windows AS (SELECT r, 500 * b + j AS i, md5_number(substr(part, 2 * j + 1, 800)) AS k FROM starts),
repeated AS (SELECT k FROM windows GROUP BY k HAVING count(*) > 1),
found AS (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM windows SEMI JOIN repeated USING (k)),
numbered AS (
  SELECT r, i, count(*) FILTER (WHERE before IS NULL OR i > before + 400) OVER (PARTITION BY r ORDER BY i) AS run
  FROM found
),
spans AS (SELECT r, min(i) AS s, max(i) + 400 AS e FROM numbered GROUP BY r, run),
-- As text, a character that would go in part stays: starts move on and ends back to where one begins.
whole AS (
  SELECT r, s, e, s + length(regexp_extract(substr(h, 2 * s + 1, 6), '^([89AB].)*')) // 2 AS cs,
         CASE WHEN substr(h, 2 * e + 1, 1) IN ('8', '9', 'A', 'B')
              THEN e - 1 - length(regexp_extract(substr(h, 2 * e - 5, 6), '([89AB].)*$')) // 2 ELSE e END AS ce
  FROM spans JOIN sized USING (r)
),
gaps AS (
  SELECT *, coalesce(lag(e) OVER w, 0) AS since, coalesce(lag(ce) OVER w, 0) AS csince
  FROM whole WINDOW w AS (PARTITION BY r ORDER BY s)
),
cut AS (
  SELECT r, count(*) AS n_spans, sum(e - s) AS n_removed, max(e) AS last, max(ce) AS clast,
         string_agg(substr(h, 2 * since + 1, 2 * (s - since)), '' ORDER BY s) AS kept,
         string_agg(substr(h, 2 * csince + 1, 2 * (cs - csince)), '' ORDER BY s) AS ckept
  FROM gaps JOIN sized USING (r) GROUP BY r
)
SELECT doc_id, n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN last IS NULL THEN h ELSE kept || substr(h, 2 * last + 1) END)) AS kept_sha256,
       decode(unhex(CASE WHEN last IS NULL THEN h ELSE ckept || substr(h, 2 * clast + 1) END)) AS text
FROM sized LEFT JOIN cut USING (r)"""


@query
def op2_lattice(spark, sf_dir):
    return lattice_links.near_vectors(load(spark, sf_dir, "embeddings"))


SQL["op2_lattice"] = f"""WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS w FROM embeddings
  WHERE {_USABLE} AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.w, b.w) >= CAST(0.9 AS DOUBLE)
),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT r.a AS vec_id, coalesce(max(n), 0) AS n_links, min(r.b) AS component_id, r.a = min(r.b) AS kept
FROM reach r LEFT JOIN counted c ON c.a = r.a GROUP BY r.a"""


@query
def op3_personal_data(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    return personal_data.detect(docs, personal_data.train(docs))


@query
def op4_simhash(spark, sf_dir):
    found = simhash_index.near_copies(load(spark, sf_dir, "documents"))
    return found.withColumn("fingerprint", F.lpad(F.lower(F.hex("fingerprint")), 16, "0"))


@query
def op7_quality(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    return rule_quality.scores(docs, rule_quality.train(docs, load(spark, sf_dir, "labels")))


@query
def op8_bpe(spark, sf_dir):
    return rank_bpe.digests(load(spark, sf_dir, "documents"))


@query
def op5_warc(spark, sf_dir):
    return warc_derivatives.derivatives(warc_derivatives.responses(load(spark, sf_dir, "pages")))


@query
def op6_packing(spark, sf_dir):
    return token_packing.pack_documents(load(spark, sf_dir, "documents"))


@query
def op9_cover_search(spark, sf_dir):
    return cover_search.top_products(load(spark, sf_dir, "embeddings"))


@query
def op10_wrappers(spark, sf_dir):
    return page_wrappers.page_texts(load(spark, sf_dir, "pages"))


SQL["op9_cover_search"] = f"""WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings WHERE {_USABLE}
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.w, c.w), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % {cover_search.EVERY} = 0
),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {cover_search.TOP}"""


@query
def op11_prefix_trie(spark, sf_dir):
    return prefix_trie.prefix_trie(load(spark, sf_dir, "conversations"))


# The CRC-32 of an id's digits, bit by bit: the reversed polynomial is 0xEDB88320.
_CRC = """xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(range(length(CAST(c AS VARCHAR))),
  lambda i: CAST(ascii(substr(CAST(c AS VARCHAR), i + 1, 1)) AS BIGINT))), lambda a, x: list_reduce(
  list_concat([xor(a, x)], range(8)), lambda r, j: xor(r >> 1, CASE WHEN r & 1 = 1 THEN 3988292384 ELSE 0 END))),
  4294967295)"""
SQL["op11_prefix_trie"] = f"""WITH t AS (
  SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
         length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') AS whole
  FROM conversations WHERE conv_id IS NOT NULL
),
own AS (
  SELECT c, list(md5(whole) ORDER BY turn NULLS FIRST, md5(whole)) AS turns,
         list(CAST(strlen(text) AS BIGINT) ORDER BY turn NULLS FIRST, md5(whole)) AS sizes
  FROM t GROUP BY c
),
heads AS (SELECT c, turns, sizes, {_CRC} % 9 AS h FROM own),
made AS (
  SELECT a.c, list_concat(coalesce(b.turns[:a.h], []), a.turns[a.h + 1:]) AS turns,
         list_concat(coalesce(b.sizes[:a.h], []), a.sizes[a.h + 1:]) AS sizes
  FROM heads a LEFT JOIN heads b ON b.c = a.c - a.c % 5
),
levels AS (SELECT c, turns, sizes, unnest(range(len(turns) + 1)) AS depth FROM made),
members AS (
  SELECT c, depth, turns[:depth] AS prefix, turns[:depth - 1] AS above, coalesce(sizes[depth], 0) AS bytes,
         len(turns) = depth AS ends
  FROM levels
),
nodes AS (
  SELECT prefix, depth, min(c) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes, any_value(above) AS above,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256
  FROM members GROUP BY prefix, depth
),
kids AS (SELECT above AS prefix, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY above),
full_nodes AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN kids k USING (prefix)),
lines AS (SELECT *, unnest(range(depth + 1)) AS up FROM full_nodes),
sums AS (
  SELECT prefix[:up] AS prefix, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
         sum((n_convs - 1) * bytes) AS saved_tokens
  FROM lines GROUP BY 1
)
SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children,
       CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, f.ends_sha256
FROM full_nodes f JOIN sums s USING (prefix) LEFT JOIN nodes p ON f.depth > 0 AND p.prefix = f.above"""


@query
def op13_collocations(spark, sf_dir):
    return phrase_mining.collocations(load(spark, sf_dir, "documents"))


SQL["op13_collocations"] = """WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents WHERE text IS NOT NULL
),
pieces AS (
  SELECT lang, unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM d
),
worded AS (SELECT lang, regexp_extract_all(piece, '[^ \\t]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM worded GROUP BY lang),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM worded, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k
),
f AS (SELECT lang, phrase, k, CAST(count(*) AS HUGEINT) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30),
cuts AS (SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS k FROM f WHERE k > 1),
halves AS (
  SELECT c.lang, c.phrase, c.a, c.k, l.f AS l, r.f AS r, 2000000 * c.a // (l.f + r.f) AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[:c.k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.k + 1:], ' ')
),
best AS (
  SELECT * FROM halves QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
),
longer AS (SELECT lang, f, string_split(phrase, ' ') AS w FROM f WHERE k > 2),
sized AS (SELECT *, unnest(range(2, len(w))) AS size FROM longer),
inside AS (SELECT lang, f, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase FROM sized),
most AS (SELECT lang, phrase, max(f) AS most FROM inside GROUP BY ALL),
kept AS (
  SELECT b.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
  FROM best b LEFT JOIN most m USING (lang, phrase) WHERE most IS NULL OR 100 * most < 80 * a
)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n,
       CAST(score AS BIGINT) AS score
FROM kept JOIN totals USING (lang) WHERE rank <= 2000"""


@query
def op12_secrets(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    return secret_models.detect(docs, secret_models.train(docs))
