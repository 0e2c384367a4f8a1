"""Registered queries of the operators (opN_<name>) and their DuckDB SQL."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from barforge.llm import (bitpack, bloomlm, chat, collocations, decontam, divergence, itq, mil, packing, secrets, simhash, template,
                          warc)
from barforge.llm.common import table
from barforge.session import scratch_path

PAGE_REVISIT_BYTES = 1000


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "warc")
    manifest = warc.write_warc(table(spark, sf_dir, "pages"), out, "page_id", "url", "html",
                               revisit_bytes=PAGE_REVISIT_BYTES)
    return warc.read_warc(manifest, out).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.simhash_components(table(spark, sf_dir, "documents"), shingle=3, radius=2, seed=42)
    return out.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                      "component_id")


def op8_bitpack(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "token-files")
    manifest = bitpack.write_packed(table(spark, sf_dir, "documents"), out,
                                    public_tokenizers.path("word_bpe_49k.json"), vocabulary=49_408)
    return bitpack.read_packed(manifest, out).withColumnRenamed("id", "doc_id")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_bloomlm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    shards = bloomlm.shards_for(docs)
    model = bloomlm.train(docs.where(~bloomlm.held_out(F.col("doc_id"))), shards)
    out = bloomlm.score(docs, model, shards)
    return out.select(F.col("id").alias("doc_id"), bloomlm.held_out(F.col("id")).alias("held_out"), "n_tokens", "n_known",
                      "train_tokens", "base_score", "score")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["rank"] < 3)

    def of_kind(kind: str):
        # a second parameter, even one with a default, would be given the place in the array
        return lambda s: s["rank"] == secrets.KINDS.index(kind)

    counts = [F.size(F.filter("spans", of_kind(kind))).cast("bigint").alias(f"n_{kind}") for kind in secrets.KINDS[:3]]
    return found.select(F.col("id").alias("doc_id"), *counts, F.sha2(secrets.span_text(base), 256).alias("base_sha256"),
                        secrets.span_text(F.col("spans")).alias("spans"))


def op5_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.array_sort(F.transform("item_ids", lambda i: i.cast("string")))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), "contaminated")


def op7_itq(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = itq.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.9)
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id",
                        (F.col("id") == F.col("component_id")).alias("kept"))


REPLY_SCHEMA = [("reply", "length", "integer", True, 0.0, 400.0), ("reply", "query", "string", True, None, None),
                ("reply", "turn", "integer", True, 0.0, None)]


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user turn is a call of ``reply``, the turn after it, if the assistant's, its result.

    A call depends on the user turn before it; of every four, the second depends on the
    third as well, which lies after it, and the third on none.
    """
    turns = table(spark, sf_dir, "conversations")
    name = lambda shift: F.concat("conv_id", F.lit(":"), F.col("turn") + shift)
    arguments = F.to_json(F.struct(F.col("turn"), F.col("text").alias("query"), F.length("text").alias("length")), {"ignoreNullFields": "false"})
    place = F.expr("pmod(turn div 2, 4)")
    needs = F.when(place == 1, F.array(name(-2), name(2))).when(place == 2, F.array().cast("array<string>")).otherwise(F.array(name(-2)))
    calls = turns.where("role = 'user'").select(
        "conv_id", "turn", name(0).alias("call_id"), F.lit("reply").alias("name"), arguments.alias("arguments"), needs.alias("depends_on"))
    results = turns.where("role = 'assistant'").select("conv_id", name(-1).alias("call_id"), F.col("text").alias("content"))
    schemas = spark.createDataFrame(REPLY_SCHEMA, "name string, param string, type string, required boolean, minimum double, maximum double")
    return chat.linked_calls(calls, results, schemas).drop("call_id").withColumn("problems", F.array_join("problems", ","))


def op10_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = mil.score(docs, mil.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(F.col("_id").alias("doc_id"), mil.held_out(F.col("_id")).alias("held_out"), F.col("_score").alias("score"),
                         (F.col("_score") >= 0.5).cast("int").alias("predicted"))


def op11_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = template.main_texts(table(spark, sf_dir, "pages"))
    return found.select(F.col("id").cast("bigint").alias("page_id"), "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergences(table(spark, sf_dir, "documents"), least_docs=30, smooth=5, top=50)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), support=30, top=2000)


QUERIES = {"op1_warc": op1_warc, "op2_secrets": op2_secrets, "op3_simhash": op3_simhash, "op4_packing": op4_packing,
           "op5_decontam": op5_decontam, "op6_chat": op6_chat, "op7_itq": op7_itq, "op8_bitpack": op8_bitpack,
           "op9_bloomlm": op9_bloomlm, "op10_mil": op10_mil, "op11_template": op11_template, "op12_divergence": op12_divergence,
           "op13_collocations": op13_collocations}
TERMS = (rf"regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), "
         r"'[^\x00-\x40\x5B-\x60\x7B-\x7F]+')")
PIECES = (rf"string_split_regex(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), "
          r"'[.,;:!?\x0A-\x0D]')")
ITEM_WORDS = rf"regexp_extract_all(translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '{decontam.WORD}')"
SQL: dict[str, str] = {
    "op5_decontam": f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({ITEM_WORDS}, []) AS w FROM documents),
             b AS (SELECT item_id, {ITEM_WORDS} AS w FROM benchmark WHERE len({ITEM_WORDS}) > 0),
             cut AS (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS k FROM b),
             win AS (SELECT DISTINCT item_id, list_slice(w, k, k + 12) AS g FROM cut),
             p AS (SELECT r, generate_subscripts(w, 1) AS k, unnest(w) AS word FROM d),
             grams AS (SELECT r, k, string_agg(word, ' ') OVER f AS g, count(*) OVER f AS n FROM p
                       WINDOW f AS (PARTITION BY r ORDER BY k ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)),
             hits AS (SELECT r, item_id, k, 13 AS n FROM grams
                      JOIN (SELECT item_id, array_to_string(g, ' ') AS g FROM win WHERE len(g) = 13) USING (g) WHERE n = 13
                      UNION ALL
                      SELECT r, item_id, k, len(g) FROM (SELECT * FROM win WHERE len(g) < 13) JOIN p ON word = g[1] JOIN d USING (r)
                      WHERE list_slice(w, k, k + len(g) - 1) = g),
             places AS (SELECT r, unnest(range(k, k + n)) AS place FROM hits),
             h AS (SELECT r, count(DISTINCT place) AS n_hit FROM places GROUP BY r),
             n AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
                   FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
        FROM d LEFT JOIN h USING (r) LEFT JOIN n USING (r)
    """,
    "op1_warc": f"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
             d AS (SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS payload_digest FROM p),
             k AS (SELECT payload_digest, max(page_id) AS kept FROM d WHERE payload_bytes >= {PAGE_REVISIT_BYTES}
                   GROUP BY payload_digest)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN kept <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN kept <> page_id THEN kept END AS refers_to
        FROM d LEFT JOIN k USING (payload_digest)
    """,
    "op6_chat": """
        WITH c0 AS (SELECT conv_id, turn, text, count(*) AS copies, conv_id || ':' || turn AS id,
                           json_object('length', length(text), 'query', text, 'turn', turn) AS arguments
                    FROM conversations WHERE role = 'user' GROUP BY ALL),
             c AS (SELECT *, id IS NOT NULL AND row_number() OVER (PARTITION BY id ORDER BY CAST(json_object('turn', turn, 'query', text) AS VARCHAR)) = 1 AS known
                   FROM c0),
             r AS (SELECT conv_id, conv_id || ':' || (turn - 1) AS id, text AS result FROM conversations WHERE role = 'assistant'),
             n AS (SELECT id, count(*) AS n FROM r WHERE id IS NOT NULL GROUP BY id),
             next AS (SELECT DISTINCT conv_id || ':' || (turn - 2) AS id, true AS later FROM c WHERE known),
             rows AS (SELECT c.conv_id, c.turn, copies, known, c.id, arguments, r.id IS NOT NULL AS linked, coalesce(CASE WHEN known THEN n END, 0) AS n_results,
                             result, later, text
                      FROM c LEFT JOIN r ON known AND c.id = r.id LEFT JOIN n ON c.id = n.id LEFT JOIN next ON c.id = next.id)
        SELECT conv_id, turn, CAST(CASE WHEN known AND (turn // 2) % 4 = 1 AND later THEN 1 ELSE 0 END AS BIGINT) AS level, false AS cyclic, copies,
               linked, n_results,
               concat_ws(',', CASE WHEN id IS NOT NULL AND NOT known THEN 'id' END,
                         CASE WHEN text IS NULL THEN 'length,query' WHEN length(text) > 400 THEN 'length' END,
                         CASE WHEN turn IS NULL THEN 'turn' END) AS problems,
               CAST(json_object('arguments', arguments, 'id', id, 'name', 'reply', 'result', result) AS VARCHAR) AS json
        FROM rows
        UNION ALL
        SELECT conv_id, NULL, NULL, NULL, NULL, false, 0, 'call',
               CAST(json_object('arguments', NULL, 'id', id, 'name', NULL, 'result', result) AS VARCHAR)
        FROM r WHERE NOT EXISTS (SELECT 1 FROM c WHERE known AND c.id = r.id)
    """,
    "op12_divergence": f"""
        WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {TERMS} AS w FROM documents),
             g AS (SELECT DISTINCT lang, source FROM d),
             t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
             kept AS (SELECT lang, term FROM t GROUP BY 1, 2 HAVING count(DISTINCT r) >= 30),
             c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
             v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
             q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 5)) // (sum(sum(n)) OVER (PARTITION BY lang) + 5 * any_value(v)) AS q
                   FROM c JOIN v USING (lang) GROUP BY lang, term),
             grid AS (SELECT g.lang, g.source, kept.term, coalesce(n, 0) AS n FROM g JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
             p AS (SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang, source) + 5 * v) AS p
                   FROM grid JOIN v USING (lang)),
             pairs AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
                       FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
             whole AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
                       LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source),
             best AS (SELECT lang, source, term AS item, p - q AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
             rows AS (SELECT *, 'pair' AS part FROM whole UNION ALL BY NAME SELECT *, 'term' AS part FROM best)
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
               CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
        FROM rows QUALIFY part = 'pair' OR rank <= 50
    """,
    "op13_collocations": f"""
        WITH s AS (SELECT coalesce(lang, 'und') AS lang, unnest({PIECES}) AS piece FROM documents),
             w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM s),
             n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
             g AS (SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(list_slice(w, i, i + m - 1), ' '))) AS phrase
                   FROM w, (SELECT unnest(range(1, 5)) AS m) WHERE len(w) >= m),
             f AS (SELECT lang, m, phrase, count(*) AS f FROM g GROUP BY ALL),
             c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m >= 2 AND f >= 30),
             cut AS (SELECT x.lang, x.phrase, a, k, l.f AS l, r.f AS r, CAST((2000000::HUGEINT * a) // (l.f + r.f) AS BIGINT) AS score
                     FROM (SELECT *, unnest(range(1, m)) AS k FROM c) x
                     JOIN f l ON l.lang = x.lang AND l.phrase = array_to_string(list_slice(w, 1, k), ' ')
                     JOIN f r ON r.lang = x.lang AND r.phrase = array_to_string(list_slice(w, k + 1, x.m), ' ')),
             low AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
             part AS (SELECT lang, a AS f, array_to_string(list_slice(w, i, i + j - 1), ' ') AS phrase
                      FROM (SELECT *, unnest(range(1, m - j + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS j FROM c WHERE m >= 3))),
             gone AS (SELECT DISTINCT lang, phrase FROM part JOIN c USING (lang, phrase) WHERE 100::HUGEINT * part.f >= 80::HUGEINT * c.a)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
        FROM low JOIN n USING (lang) ANTI JOIN gone USING (lang, phrase) QUALIFY rank <= 2000
    """,
    "op7_itq": """
        WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
             l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
                   AND list_cosine_similarity(a.e, b.e) >= 0.9),
             n AS (SELECT a, count(*) AS n FROM l GROUP BY a),
             c AS (WITH RECURSIVE walk(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT walk.a, l.b FROM walk JOIN l ON walk.b = l.a)
                   SELECT a, min(b) AS component_id FROM walk GROUP BY a)
        SELECT vec_id, coalesce(n, 0) AS n_links, component_id, component_id = vec_id AS kept
        FROM v JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id
    """,
}
