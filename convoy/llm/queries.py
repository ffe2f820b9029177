"""The registered queries: ``opN_<name>(spark, sf_dir)`` over whole tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convoy.session import configure
from convoy.llm import ann, decontaminate, filter_audit, fuzzy_lines, language_id, lm, mixing, ngram_join, prefix_trie, shuffled_shards, suffix_dedup, token_files, toxicity
from convoy.llm.common import crc_mod, importable, table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    seen = table(spark, sf_dir, "labels").filter(crc_mod("doc_id", 4) != 2).select("doc_id", "toxic")
    scored = toxicity.score(docs, toxicity.train(docs, seen))
    return scored.select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = ngram_join.join(table(spark, sf_dir, "documents"), n=4, percent=85)
    return joined.select("doc_id", "n_shingles", "component_id", "n_links")


def op3_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.search(rows, rows.filter("vec_id % 100 = 0"), "vec_id", "embedding", k=10)


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", crc_mod("doc_id", 10) == 0)
    return lm.score(docs, keep=1).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), weights=[3, 1, 2], share=1.5, most=2.0)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), length=50)


def op7_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_lines.remove_lines(table(spark, sf_dir, "documents"), similarity=0.8, distance=3, grams=True)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), n=5, threshold=0.8)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.write_and_read(table(spark, sf_dir, "documents"), tokenizer_path(), end=1)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs.filter(crc_mod("doc_id", 5) != 0))
    return language_id.predict(docs, model).select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = shuffled_shards.shuffle_to_shards(table(spark, sf_dir, "documents"), shards=16)
    raw = F.coalesce("record.text", F.lit("")).cast("binary")
    return stored.select("record.doc_id", (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
                         F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"), block=20, share=4)


def _run(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(importable(configure(spark)), sf_dir)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {q.__name__: _run(q) for q in [
    op1_toxicity, op2_ngram_join, op3_ann, op4_lm_scoring, op5_mixing, op6_suffix_dedup, op7_fuzzy_lines, op8_decontamination, op9_token_files, op10_language_id,
    op11_filter_audit, op12_sharding, op13_prefix_trie,
]}

#: DuckDB SQL for the queries that SQL can express on whole tables.
ORACLE: dict[str, str] = {
    "op8_decontamination": r"""
WITH low AS (
  SELECT doc_id AS id, 0 AS item, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
  UNION ALL
  SELECT item_id, 1, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
w AS (SELECT id, item, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM low WHERE id IS NOT NULL AND t IS NOT NULL),
pos AS (SELECT id, item, w, unnest(range(1, greatest(len(w) - 5, 0) + 2)) AS i FROM w WHERE len(w) > 0),
s AS (SELECT DISTINCT id, item, array_to_string(w[i:i + 4], ' ') AS s FROM pos),
size AS (SELECT id, count(*) AS n FROM s WHERE item = 1 GROUP BY id)
SELECT d.id AS doc_id, b.id AS item_id, max(size.n) AS item_shingles, count(*) AS found, count(*) / max(size.n) AS containment
FROM s d JOIN s b ON d.s = b.s AND d.item = 0 AND b.item = 1 JOIN size ON size.id = b.id
GROUP BY d.id, b.id HAVING 5 * count(*) >= 4 * max(size.n)""",
    "op11_filter_audit": r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS least FROM d),
f AS (SELECT doc_id, part, len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
        100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
        coalesce(doc_id > least, false) AS e FROM w),
known AS (SELECT doc_id, bool_or(quality IS NOT DISTINCT FROM 1) AS good, bool_or(toxic IS NOT DISTINCT FROM 1) AS toxic
          FROM labels GROUP BY doc_id),
rows_ AS (SELECT part, concat(CASE WHEN a THEN 'A' ELSE '' END, CASE WHEN b THEN 'B' ELSE '' END, CASE WHEN c THEN 'C' ELSE '' END,
            CASE WHEN d THEN 'D' ELSE '' END, CASE WHEN e THEN 'E' ELSE '' END) AS failed,
            coalesce(good, false) AS good, coalesce(toxic, false) AS toxic FROM f LEFT JOIN known USING (doc_id)),
counts AS (SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM rows_ GROUP BY ALL),
l(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (SELECT concat(l1.x, l2.x, l3.x, l4.x, l5.x) AS o FROM l l1, l l2, l l3, l l4, l l5
           WHERE len(list_distinct([l1.x, l2.x, l3.x, l4.x, l5.x])) = 5),
steps AS (SELECT o, unnest([1, 2, 3, 4, 5]) AS step FROM orders),
seen AS (SELECT part, o, step, n, good, toxic, failed, o[step] AS own, contains(failed, o[step]) AS fails,
           len(list_filter(str_split(o[1:step - 1], ''), lambda x: x <> '' AND contains(failed, x))) > 0 AS before FROM steps, counts),
out AS (SELECT part, o, step, own, sum(CASE WHEN NOT fails AND NOT before THEN n ELSE 0 END) AS kept,
          sum(CASE WHEN fails AND NOT before THEN n ELSE 0 END) AS removed,
          sum(CASE WHEN fails AND before THEN n ELSE 0 END) AS redundant,
          sum(CASE WHEN failed = own THEN n ELSE 0 END) AS unique_fails,
          sum(CASE WHEN fails AND NOT before THEN good ELSE 0 END) AS good_lost,
          sum(CASE WHEN fails AND NOT before THEN toxic ELSE 0 END) AS toxic_lost FROM seen GROUP BY ALL)
SELECT part, o AS filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM out""",
    "op13_prefix_trie": r"""
WITH RECURSIVE t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS n
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY n) AS turns FROM t GROUP BY conv_id),
-- crc32 of the decimal id, one bit a step; 32 bits of each character
crc AS (SELECT conv_id, conv_id::VARCHAR AS s, 0 AS k, 4294967295::BIGINT AS c FROM own
  UNION ALL
  SELECT conv_id, s, k + 1, CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END FROM (
    SELECT conv_id, s, k, CASE WHEN k % 8 = 0 THEN xor(c, ascii(s[k // 8 + 1])::BIGINT) ELSE c END AS x FROM crc WHERE k < 8 * length(s))),
h AS (SELECT conv_id, xor(c, 4294967295) % 4 AS h FROM crc WHERE k = 8 * length(s)),
built AS (SELECT own.conv_id, list_concat(coalesce(base.turns, [])[:h], own.turns[h + 1:]) AS turns
  FROM own JOIN h USING (conv_id) LEFT JOIN own base ON base.conv_id = own.conv_id - own.conv_id % 20),
pre AS (SELECT conv_id, turns[:d] AS p, d, len(turns) AS l FROM built, LATERAL (SELECT unnest(range(0, len(turns) + 1)) AS d)),
node AS (SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (d = l), '')) AS ends_sha256 FROM pre GROUP BY p, d),
kid AS (SELECT p[:d - 1] AS p, d - 1 AS d, count(*) AS n_children FROM node WHERE d > 0 GROUP BY 1, 2),
more AS (SELECT node.*, coalesce(n_children, 0) AS n_children,
    CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * len(regexp_extract_all(p[d].text, '[^\x20\x09-\x0D]+')) END AS v FROM node LEFT JOIN kid USING (p, d)),
up AS (SELECT p[:a] AS p, a AS d, sum(v) AS saved, count(*) FILTER (n_children = 0) AS n_leaves
  FROM more, LATERAL (SELECT unnest(range(0, d + 1)) AS a) GROUP BY 1, 2)
SELECT m.conv_id, m.d::BIGINT AS depth, q.conv_id AS parent_conv_id, m.n_convs, m.n_children::BIGINT AS n_children, n_leaves,
  saved::BIGINT AS saved_tokens, m.ends_sha256
FROM more m JOIN up USING (p, d) LEFT JOIN node q ON m.d > 0 AND q.d = m.d - 1 AND q.p = m.p[:m.d - 1]""",
}
