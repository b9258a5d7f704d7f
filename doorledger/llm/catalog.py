"""Registered queries of the corpus operators, each over its whole table, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doorledger.llm import chat, language
from doorledger.llm.bpe import round_trip_digests
from doorledger.llm.common import fold, table
from doorledger.llm.exact_dedup import exact_groups
from doorledger.llm.lexical_search import ranked
from doorledger.llm.near_dedup import near_groups
from doorledger.llm.packing import packed
from doorledger.llm.prefix_trie import BLOCK, nodes
from doorledger.llm.source_mix import mixed
from doorledger.llm.suffix_dedup import digests
from doorledger.llm.toxicity import score, train
from doorledger.llm.url_filter import RULES, judged
from doorledger.llm.vector_dedup import vector_groups


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip_digests(table(spark, sf_dir, "documents"), tokenizer_file()).withColumnRenamed("id", "doc_id")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages").select("page_id", "url", "html"), RULES).select("page_id", "host", "path", "rule", "verdict")


SQL2 = r"""
WITH RECURSIVE links AS (
  SELECT url, replace(t, '&amp;', '&') AS t FROM (SELECT url, unnest(list_concat(
    [regexp_extract(x, '(?i)\bhref\s*=\s*["'']?([^"''\s>]+)', 1)
     FOR x IN regexp_extract_all(html, '(?i)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>')],
    [regexp_extract(x, '(?i)\burl\s*=\s*["'']?([^"''\s>]+)', 1)
     FOR x IN regexp_extract_all(html, '(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>')])) AS t
  FROM pages WHERE url IS NOT NULL AND html IS NOT NULL)),
edges AS (
  SELECT url, CASE WHEN t LIKE '//%' THEN substr(url, 1, strpos(url, '://')) || t
    WHEN t LIKE '/%' THEN substr(url, 1, strpos(url, '://') + 2) || regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*') || t
    ELSE t END AS target FROM links),
pairs AS (
  SELECT url AS a, target AS b FROM edges WHERE contains(target, '://')
  UNION SELECT target, url FROM edges WHERE contains(target, '://')),
urls AS (SELECT url FROM pages UNION SELECT a FROM pairs),
rests AS (SELECT url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM urls),
cuts AS (
  SELECT url, rest, least(coalesce(nullif(strpos(rest, '/'), 0), length(rest) + 1), coalesce(nullif(strpos(rest, '?'), 0), length(rest) + 1),
                          coalesce(nullif(strpos(rest, '#'), 0), length(rest) + 1)) AS h,
         least(coalesce(nullif(strpos(rest, '?'), 0), length(rest) + 1), coalesce(nullif(strpos(rest, '#'), 0), length(rest) + 1)) AS p FROM rests),
parts AS (
  SELECT url, translate(substr(rest, 1, h - 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         substr(rest, h, p - h) AS path FROM cuts),
ruled AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.www.example.com' AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/') THEN 'com/' END AS rule FROM parts),
blocked AS (
  SELECT url AS u FROM ruled WHERE rule IN ('example.com/en/', 'net/fr/', 'net/es/')
  UNION SELECT b FROM blocked JOIN pairs ON a = u)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('www.example.com/en/', 'com/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN p.url IN (SELECT u FROM blocked WHERE u IS NOT NULL) THEN 'block' ELSE 'allow' END AS verdict
FROM pages p JOIN ruled r ON p.url IS NOT DISTINCT FROM r.url"""


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "component_id", "kept")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs)
    return (docs.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), language.predicted(F.col("text"), model).alias("p"))
            .select("doc_id", "held_out", "p.lang_pred", "p.score"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


SQL5 = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
FROM t WINDOW g AS (PARTITION BY norm)"""


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(more)
    return chat.digests(rows)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    return (docs.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"),
                        score(F.col("text"), model).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_groups(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


SQL9 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT vec_id, vec_id AS r FROM embeddings UNION SELECT reach.vec_id, link.b FROM reach JOIN link ON link.a = reach.r)
SELECT vec_id, (SELECT count(*) FROM link WHERE a = vec_id) AS n_links, min(r) AS component_id, vec_id = min(r) AS kept
FROM reach GROUP BY vec_id"""


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"), tokenizer_file()).withColumnRenamed("id", "doc_id")


def op11_bag_dedup_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


SQL11 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents WHERE text IS NOT NULL),
i AS (
  SELECT row_number() OVER () AS r, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM benchmark),
s AS (SELECT count(*)::BIGINT AS docs, sum(len(terms))::BIGINT AS total FROM d WHERE len(terms) > 0),
asked AS (SELECT r, item_id, term, count(*)::BIGINT AS c FROM (SELECT r, item_id, unnest(terms) AS term FROM i) GROUP BY ALL),
tf AS (
  SELECT doc_id, term, 75 + ((25 * n * docs) // total) AS m, count(*)::BIGINT AS tf
  FROM (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM d) CROSS JOIN s
  WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term, m),
w AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf CROSS JOIN s GROUP BY term),
scored AS (
  SELECT r, item_id, doc_id, sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM asked JOIN tf USING (term) JOIN w USING (term) GROUP BY r, item_id, doc_id),
ordered AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ordered WHERE rank <= 20"""


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nodes(table(spark, sf_dir, "conversations"), block=BLOCK)


SQL12 = """
WITH own AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
crc AS (
  SELECT conv_id, turns, xor(list_reduce(list_prepend(4294967295::BIGINT, [ascii(x)::BIGINT FOR x IN string_split(conv_id::VARCHAR, '')]),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 6 AS h FROM own),
built AS (
  SELECT c.conv_id, CASE WHEN c.conv_id % 100 = 0 THEN c.turns
    ELSE list_concat(coalesce(list_slice(b.turns, 1, c.h), []), list_slice(c.turns, c.h + 1, len(c.turns))) END AS turns
  FROM crc c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100),
pre AS (SELECT conv_id, d AS depth, list_slice(turns, 1, d) AS p, d = len(turns) AS is_end FROM built, unnest(range(0, len(turns) + 1)) x(d)),
node AS (
  SELECT p, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (is_end), '')) AS ends_sha256
  FROM pre GROUP BY p),
up AS (
  SELECT n.*, CASE WHEN n.depth > 0 THEN list_slice(p, 1, n.depth - 1) END AS q,
         CASE WHEN n.depth > 0 THEN (n_convs - 1) * length(p[n.depth].t) ELSE 0 END AS own FROM node n),
kids AS (SELECT q, count(*) AS n FROM up WHERE q IS NOT NULL GROUP BY q),
whole AS (
  SELECT u.p, u.own, (k.n IS NULL)::BIGINT AS leaf, unnest([list_slice(u.p, 1, x) FOR x IN range(0, u.depth + 1)]) AS a
  FROM up u LEFT JOIN kids k ON k.q = u.p),
total AS (SELECT a, sum(leaf) AS leaves, sum(own) AS saved FROM whole GROUP BY a)
SELECT u.conv_id, u.depth::BIGINT AS depth, o.conv_id AS parent_conv_id, u.n_convs, coalesce(k.n, 0) AS n_children,
       t.leaves::BIGINT AS n_leaves, t.saved::BIGINT AS saved_tokens, u.ends_sha256
FROM up u JOIN total t ON t.a = u.p LEFT JOIN kids k ON k.q = u.p LEFT JOIN node o ON o.p = u.q"""


def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixed(table(spark, sf_dir, "documents"), F.array("source"))
    return found.select(F.col("id").alias("doc_id"), "size", F.col("source_sizes")[0].alias("source_size"),
                        F.col("targets")[0].alias("target"), "taken")


QUERIES = {
    "op1_bpe_round_trip": (op1_bpe_round_trip, None),
    "op2_url_filter": (op2_url_filter, SQL2),
    "op3_minhash_near_dedup": (op3_minhash_near_dedup, None),
    "op4_language_id": (op4_language_id, None),
    "op5_exact_dedup": (op5_exact_dedup, SQL5),
    "op6_chat_format": (op6_chat_format, None),
    "op7_suffix_dedup": (op7_suffix_dedup, None),
    "op8_toxicity": (op8_toxicity, None),
    "op9_embedding_near_dedup": (op9_embedding_near_dedup, SQL9),
    "op10_best_fit_packing": (op10_best_fit_packing, None),
    "op11_bag_dedup_search": (op11_bag_dedup_search, SQL11),
    "op12_prefix_trie": (op12_prefix_trie, SQL12),
    "op13_source_mix": (op13_source_mix, None),
}
