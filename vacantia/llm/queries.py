"""The operators of this folder over the given tables, with check SQL where SQL can say it."""

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession, functions as F

from vacantia.llm import contamination, embeddings, hilbert, jaccard, licenses, mixing, packing, phrases, prefixes, secrets, strata, suffixes, toxicity


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contamination.contamination(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    ).drop("spans", "items")


def op2_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.similar(table(spark, folder, "documents"))


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.plan(table(spark, folder, "documents"))


def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, folder, "documents"))


def op5_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, folder, "embeddings"))


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.scores(table(spark, folder, "documents"), table(spark, folder, "labels")).drop("sentences")


def op7_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secrets(table(spark, folder, "documents"))


def op8_sharding(spark: SparkSession, folder: str) -> DataFrame:
    out = hilbert.shard(table(spark, folder, "documents"), keep=False)
    return out.select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "curve"
    )


def op9_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """The documents as files of a tree: by source, language and number, at three depths."""
    number = F.col("doc_id").cast("string")
    deep = F.array("source", "lang", F.expr("CAST(doc_id DIV 500 AS STRING)"))
    depth = F.when(F.col("doc_id") % 50 == 0, 1).when(F.col("doc_id") % 10 == 0, 2).otherwise(3)
    path = F.array_join(F.slice(deep, F.lit(1), depth), "/")
    return licenses.licenses(table(spark, folder, "documents"), F.concat_ws("/", path, number))


def op10_repeated_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.remove_phrases(table(spark, folder, "documents"))


def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return strata.search(strata.build(table(spark, folder, "documents")), table(spark, folder, "benchmark"))


def op12_packing(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers  # only the place of its files

    pieces = packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefixes.trie(prefixes.rebuilt(table(spark, folder, "conversations")))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_mixing": op3_mixing,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_embedding_dedup": op5_embedding_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_secrets": op7_secrets,
    "op8_sharding": op8_sharding,
    "op9_licenses": op9_licenses,
    "op10_repeated_phrases": op10_repeated_phrases,
    "op11_ranked_search": op11_ranked_search,
    "op12_packing": op12_packing,
    "op13_prefix_trie": op13_prefix_trie,
    "pipeline": corpus_pipeline.run,
}

WORDS_SQL = "regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLES = {
    "op2_jaccard_join": f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce({WORDS_SQL.format('text')}, []) AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + least(len(w), 5) - 1], ' ') AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
link AS (
  SELECT p.a, p.b, na.n = p.c AND nb.n = p.c AS same
  FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id
        GROUP BY ALL) p
  JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b WHERE 5 * p.c >= 4 * (na.n + nb.n - p.c)),
reach AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
low AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
own AS (SELECT a, count(*) AS n, min(CASE WHEN same THEN b END) AS b FROM link GROUP BY a)
SELECT doc_id, least(doc_id, coalesce(own.b, doc_id)) AS class_id, coalesce(own.n, 0) AS n_links,
  least(doc_id, coalesce(low.b, doc_id)) AS component_id
FROM d LEFT JOIN low ON doc_id = low.a LEFT JOIN own ON doc_id = own.a
""",
    "op5_embedding_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
low AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(b, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(b, vec_id)) AS kept
FROM embeddings LEFT JOIN low ON vec_id = low.a LEFT JOIN n ON vec_id = n.a
""",
    "op1_decontamination": f"""
WITH d AS (SELECT doc_id, coalesce({WORDS_SQL.format('text')}, []) AS w FROM documents),
b AS (SELECT item_id, {WORDS_SQL.format('text')} AS w FROM benchmark WHERE text IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS i FROM b WHERE len(w) > 0)),
pos AS (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS i FROM d),
hit AS (
  SELECT doc_id, i, n, item_id
  FROM (SELECT p.doc_id, p.i, k.n, array_to_string(p.w[p.i : p.i + k.n - 1], ' ') AS s
        FROM pos p, (SELECT DISTINCT n FROM win) k WHERE p.i + k.n - 1 <= len(p.w))
  JOIN win USING (n, s)),
words AS (SELECT doc_id, count(DISTINCT j) AS n_hit
          FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS j FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
""",
    "op11_ranked_search": f"""
WITH t AS (SELECT doc_id, unnest({WORDS_SQL.format('text')}) AS w FROM documents),
p AS (SELECT doc_id, w, count(*) AS tf FROM t GROUP BY ALL),
d AS (SELECT doc_id, count(*) AS n FROM t GROUP BY ALL),
c AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM d),
m AS (SELECT doc_id, 100 - 75 + (75 * n * big_n) // big_l AS m FROM d, c),
f AS (SELECT w, CAST(floor(1000 * ln(CAST(2 * any_value(big_n) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS weight
      FROM p, c GROUP BY w),
q AS (SELECT item_id, w, count(*) AS times
      FROM (SELECT item_id, unnest({WORDS_SQL.format('text')}) AS w FROM benchmark) GROUP BY ALL),
s AS (SELECT item_id, doc_id, CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
      FROM q JOIN f USING (w) JOIN p USING (w) JOIN m USING (doc_id) GROUP BY ALL)
SELECT item_id, CAST(r AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS r FROM s WHERE score > 0) WHERE r <= 10
""",
    "op13_prefix_trie": """
WITH t AS (
  SELECT conv_id, turn, md5(length(r) || ':' || r || x) AS k, strlen(x) AS b
  FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL)),
o AS (SELECT conv_id, list({'k': k, 'b': b} ORDER BY turn NULLS FIRST, k) AS l FROM t GROUP BY conv_id),
h AS (
  SELECT conv_id, xor(list_reduce(list_concat([4294967295::BIGINT], [ord(c)::BIGINT FOR c IN string_split(CAST(conv_id AS VARCHAR), '')]),
    lambda acc, byte: list_reduce(list_concat([xor(acc, byte)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
      lambda x, z: xor(x >> 1, 3988292384::BIGINT * (x & 1)))), 4294967295::BIGINT) % 9 AS h
  FROM o),
r AS (
  SELECT o.conv_id, list_concat(coalesce(f.l, [])[1:h.h], o.l[h.h + 1:]) AS l
  FROM o JOIN h USING (conv_id) LEFT JOIN o f ON f.conv_id = o.conv_id - o.conv_id % 5),
m AS (
  SELECT conv_id, d, md5(array_to_string([e.k FOR e IN l[1:d]], '')) AS p, md5(array_to_string([e.k FOR e IN l[1:d - 1]], '')) AS pp,
    len(l) = d AS ended, CASE WHEN d > 0 THEN l[d].b ELSE 0 END AS b
  FROM (SELECT conv_id, l, unnest(generate_series(0, len(l))) AS d FROM r)),
n AS (
  SELECT d, p, any_value(pp) AS pp, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(b) AS b,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ended), '')) AS ends_sha256
  FROM m GROUP BY d, p),
c AS (SELECT d - 1 AS d, pp AS p, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
u AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN c USING (d, p)),
s AS (
  SELECT m.d, m.p, CAST(sum((u.n_convs - 1) * u.b) AS BIGINT) AS saved_tokens, count(*) FILTER (WHERE u.n_children = 0) AS n_leaves
  FROM u JOIN m ON m.conv_id = u.conv_id AND m.d <= u.d GROUP BY m.d, m.p)
SELECT u.conv_id, u.d AS depth, v.conv_id AS parent_conv_id, u.n_convs, u.n_children, s.n_leaves, s.saved_tokens, u.ends_sha256
FROM u JOIN s USING (d, p) LEFT JOIN n v ON u.d > 0 AND v.d = u.d - 1 AND v.p = u.pp
""",
}
