"""The training-data queries: one thin ``opN_<name>`` per operator over its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankforge.llm.common import table

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


OP7_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text,
                  sha256(translate(coalesce(text, ''), concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13)), '')) AS h
           FROM documents),
g AS (SELECT h, count(*) AS group_size, arg_min(doc_id, (-length(text), doc_id)) AS keep_id FROM t GROUP BY h)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, t.h AS text_sha256 FROM t JOIN g ON t.h = g.h
"""


@query("op7_exact_dedup", OP7_SQL)
def op7_exact_dedup(spark, sf_dir):
    from rankforge.llm.exact_dedup import exact_dedup
    out = exact_dedup(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


@query("op1_sentencepiece")
def op1_sentencepiece(spark, sf_dir):
    import public_tokenizers
    from rankforge.llm.sentencepiece_codec import encode_decode
    return encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")) \
        .withColumnRenamed("id", "doc_id")


@query("op8_chat_format")
def op8_chat_format(spark, sf_dir):
    from rankforge.llm.chat_format import format_conversations
    said = F.lit("<|im_end|><|im_start|>assistant ok").alias("text")
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said)
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return format_conversations(turns.unionByName(extra)).withColumnRenamed("id", "conv_id")


@query("op9_token_counts")
def op9_token_counts(spark, sf_dir):
    import public_tokenizers
    from rankforge.llm.token_counts import token_counts
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=512) \
        .withColumnRenamed("id", "doc_id")


@query("op6_toxicity")
def op6_toxicity(spark, sf_dir):
    from rankforge.llm.common import crc_mod
    from rankforge.llm.toxicity import fit, toxicity
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return toxicity(docs, model).select(F.col("id").alias("doc_id"), (crc_mod("id", 4) == 2).alias("held_out"), "score", "predicted")


@query("op2_language_id")
def op2_language_id(spark, sf_dir):
    from rankforge.llm.common import crc_mod
    from rankforge.llm.language_id import identify, learn
    docs = table(spark, sf_dir, "documents")
    out = identify(docs, learn(docs.where(crc_mod("doc_id", 4) != 2)))
    return out.select(F.col("id").alias("doc_id"), (crc_mod("id", 4) == 2).alias("held_out"), "lang_pred", "score")


@query("op5_html_extract")
def op5_html_extract(spark, sf_dir):
    from rankforge.llm.html_extract import extract_main_text
    return extract_main_text(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


@query("op4_decontamination")
def op4_decontamination(spark, sf_dir):
    from rankforge.llm.decontaminate import overlaps
    return overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).withColumnRenamed("id", "doc_id")


@query("op10_lm_scoring")
def op10_lm_scoring(spark, sf_dir):
    from rankforge.llm.common import crc_mod
    from rankforge.llm.lm_scoring import lm_scores
    docs = table(spark, sf_dir, "documents")
    out = lm_scores(docs, docs.where(crc_mod("doc_id", 10) != 0))
    return out.select(F.col("id").alias("doc_id"), (crc_mod("id", 10) == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                      "base_score", "score")


@query("op3_jaccard_join")
def op3_jaccard_join(spark, sf_dir):
    from rankforge.llm.jaccard_join import jaccard_components
    out = jaccard_components(table(spark, sf_dir, "documents"), words=4, percent=85)
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "n_links", "component_id")


def _op11_sql(k: int = 40, rounds: int = 5) -> str:
    """Lloyd's rounds one after the other, over whole numbers."""
    ctes = ["""v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
            f"""c0 AS (SELECT CAST(row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS INT) AS cluster, x
  FROM v ORDER BY sha256('2:' || vec_id) LIMIT {k})"""]
    for n in range(rounds + 1):
        ctes.append(f"""a{n} AS MATERIALIZED (SELECT r, min({{'d': d, 'cluster': cluster}}) AS best FROM (
  SELECT r, cluster, list_sum(list_transform(list_zip(v.x, c{n}.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM v CROSS JOIN c{n}) GROUP BY r)""")
        if n < rounds:
            ctes.append(f"""m{n} AS (SELECT cluster, list(f ORDER BY i) AS x FROM (
  SELECT cluster, i, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS f FROM (
    SELECT a{n}.best.cluster AS cluster, i, sum(v.x[i]) AS s, count(*) AS n
    FROM a{n} JOIN v USING (r) CROSS JOIN range(1, 65) g(i) GROUP BY ALL)) GROUP BY cluster)""")
            ctes.append(f"c{n + 1} AS MATERIALIZED (SELECT c{n}.cluster, coalesce(m{n}.x, c{n}.x) AS x FROM c{n} LEFT JOIN m{n} USING (cluster))")
    return "WITH " + ",\n".join(ctes) + f"""
SELECT vec_id, best.cluster AS cluster, CAST(best.d AS BIGINT) AS distance,
       CAST(sum(best.d) OVER (PARTITION BY best.cluster) AS BIGINT) AS cluster_inertia, CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c{rounds}.x, ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (r) JOIN c{rounds} ON c{rounds}.cluster = best.cluster
"""


@query("op11_centroid_clustering", _op11_sql())
def op11_centroid_clustering(spark, sf_dir):
    from rankforge.llm.centroid_clustering import clusters
    return clusters(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


_OP12_WORDS = """list_transform(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w)"""
OP12_SQL = f"""
WITH crc_table AS MATERIALIZED (SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, s: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc),
w AS MATERIALIZED (SELECT 'd' AS side, row_number() OVER () AS r, doc_id, {_OP12_WORDS} AS ws FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), NULL, {_OP12_WORDS} FROM benchmark),
f AS MATERIALIZED (SELECT side, r, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))) AS feature FROM w),
names AS (SELECT DISTINCT feature, hex(encode(feature)) AS h FROM f),
hashed AS MATERIALIZED (SELECT feature, xor(list_reduce(list_concat([4294967295], list_transform(range(len(h) // 2),
    lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT))), lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM names CROSS JOIN crc_table),
fb AS MATERIALIZED (SELECT side, r, bucket FROM f JOIN hashed USING (feature)),
n AS (SELECT g.bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t
      FROM range(10000) g(bucket) LEFT JOIN fb ON fb.bucket = g.bucket GROUP BY g.bucket),
gain AS MATERIALIZED (SELECT bucket, CAST(floor(1000 * ln((CAST(t AS DOUBLE) + 1) * (CAST(sum(s) OVER () AS DOUBLE) + 10000)
    / ((CAST(s AS DOUBLE) + 1) * (CAST(sum(t) OVER () AS DOUBLE) + 10000)))) AS BIGINT) AS gain FROM n),
d AS (SELECT r, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS total FROM fb JOIN gain USING (bucket) WHERE side = 'd' GROUP BY r),
scored AS MATERIALIZED (SELECT doc_id, len(ws) AS n_words, coalesce(n_features, 0) AS n_features,
    coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0) AS weight,
    CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
  FROM w LEFT JOIN d USING (r) WHERE side = 'd'),
s AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM scored),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place,
    count(*) FILTER (n_words >= 20) OVER () AS long_enough FROM s)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_words >= 20 AND place <= 25 * long_enough // 100 THEN place END AS rank FROM ranked
"""


@query("op12_importance_resampling", OP12_SQL)
def op12_importance_resampling(spark, sf_dir):
    from rankforge.llm.importance_resampling import importance_ranks
    out = importance_ranks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


def _near_sql(words: int, percent: int) -> str:
    """Documents, their sets of word shingles and the least id that links reach."""
    return f"""
WITH RECURSIVE w AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS MATERIALIZED (SELECT DISTINCT r, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < {words} THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - {words} + 2), lambda i: array_to_string(ws[i : i + {words} - 1], ' ')) END) AS g FROM w),
n AS MATERIALIZED (SELECT r, count(*) AS n FROM s GROUP BY r),
pairs AS (SELECT a.r AS a, b.r AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.r <> b.r GROUP BY a.r, b.r),
links AS MATERIALIZED (SELECT a, b FROM pairs JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * c >= {percent} * (x.n + y.n - c)),
reach AS (SELECT a AS r, a AS m FROM (SELECT DISTINCT a FROM links) UNION SELECT reach.r, links.b FROM reach JOIN links ON links.a = reach.m),
least AS (SELECT reach.r, min(w.doc_id) AS component_id FROM reach JOIN w ON w.r = reach.m GROUP BY reach.r)
"""


_NEAR_COLUMNS = """SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(least.component_id, w.doc_id) AS component_id{more}
FROM w LEFT JOIN n ON n.r = w.r LEFT JOIN least ON least.r = w.r{joins}"""
ORACLE["op3_jaccard_join"] = _near_sql(4, 85) + _NEAR_COLUMNS.format(
    more=", coalesce(l.n_links, 0) AS n_links", joins=" LEFT JOIN (SELECT a, count(*) AS n_links FROM links GROUP BY a) l ON l.a = w.r")


@query("op13_minhash_dedup", _near_sql(2, 80) + _NEAR_COLUMNS.format(more=", coalesce(least.component_id, w.doc_id) = w.doc_id AS kept", joins=""))
def op13_minhash_dedup(spark, sf_dir):
    from rankforge.llm.minhash_dedup import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80).withColumnRenamed("id", "doc_id")
