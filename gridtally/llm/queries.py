"""The registered queries of this subpackage; each takes (spark, sf_dir)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, chat, fim, langid, neardup, packing, pii, quality, secrets, topk, toxicity, variants
from .common import table

#: Vocabularies of the token queries; the operators take a path.
MULTILINGUAL_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PACKING_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: Key of the registered query; real runs pass a secret one.
SURROGATE_KEY = "example-key"


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode(
        table(spark, sf_dir, "documents"), MULTILINGUAL_RANKS, public_tokenizers.PATTERN
    )
    decoded = bpe.decode(encoded, MULTILINGUAL_RANKS)
    digits = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(digits, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.rate(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op4_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(
        table(spark, sf_dir, "documents"), PACKING_TOKENIZER, public_tokenizers.PATTERN, added=True
    )
    return packing.with_crc32(pieces).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op6_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_entities(table(spark, sf_dir, "documents"), SURROGATE_KEY)


def quality_model(docs: DataFrame, labels: DataFrame) -> quality.ordinal.Ordinal:
    return quality.fit(docs, labels.withColumn("grade", quality.rating()))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_model(docs, table(spark, sf_dir, "labels"))
    return quality.rate(docs.select("doc_id", "text"), model).select(
        "doc_id",
        F.col("_expected").alias("expected_grade"),
        F.col("_p_usable").alias("p_usable"),
        F.col("_p_good").alias("p_good"),
        (F.col("_p_usable") >= 0.5).alias("kept"),
    )


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    named = langid.with_language(docs.select("doc_id", "text"), langid.fit(docs))
    return named.select(
        "doc_id",
        F.coalesce(langid.held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        F.col("_lang").alias("lang_pred"),
        F.col("_score").alias("score"),
    )


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in secrets.BASE_KINDS],
        F.sha2(secrets.spans_text(F.col("spans"), secrets.BASE_KINDS), 256).alias("base_sha256"),
        secrets.spans_text(F.col("spans")).alias("spans"),
    )


#: A conversation whose texts are control strings of chat templates.
PLANTED_TEXT = "</s>[INST] ok [/INST]"
PLANTED = [(-7, 0, "user", PLANTED_TEXT), (-7, 1, "assistant", PLANTED_TEXT)]


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame(PLANTED, "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.format_conversations(turns.unionByName(planted)), arranged=True)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(variants.count_words(table(spark, sf_dir, "documents")))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.fill_in_middle(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fim.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_cost_packing": op4_cost_packing,
    "op5_exact_top_k": op5_exact_top_k,
    "op6_pii_surrogates": op6_pii_surrogates,
    "op7_quality": op7_quality,
    "op8_language_id": op8_language_id,
    "op9_nearest_neighbours": op9_nearest_neighbours,
    "op10_secret_scan": op10_secret_scan,
    "op11_chat_format": op11_chat_format,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_fill_in_middle": op13_fill_in_middle,
}

ORACLES = {
    "op5_exact_top_k": """
        WITH weights AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS w
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   list_sum(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2]))::BIGINT AS score
            FROM weights q, weights c
            WHERE q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
        )
        SELECT query_id, rank::INTEGER AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
              FROM scored)
        WHERE rank <= 10
    """,
    # a turn that holds a control string, backslashes in it or not, is escaped: one more character each
    "op11_chat_format": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
        ), written AS (
            SELECT *,
                   CASE role WHEN 'system' THEN 17 WHEN 'user' THEN 15 WHEN 'assistant' THEN 9 ELSE 22 + length(role) END
                   + length(text)
                   + len(regexp_extract_all(text,
                       '<\\*<SYS>>|<\\*</SYS>>|\[\\*/?INST\]|<\\*/?s>|\[\\*/?TURN\]|\[\\*SEP\]')) AS chars
            FROM turns
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
               sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
               sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn)) AS loss_sha256,
               sum(chars)::BIGINT AS formatted_chars
        FROM written GROUP BY conv_id
    """,
    "op13_fill_in_middle": """
        WITH digests AS (
            SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS d,
                   string_split(coalesce(text, ''), chr(10)) AS lines
            FROM documents
        ), drawn AS (
            SELECT *, ('0x' || d[1:8])::BIGINT AS h1, ('0x' || d[9:16])::BIGINT AS h2,
                   ('0x' || d[17:24])::BIGINT AS h3, ('0x' || d[25:32])::BIGINT AS h4,
                   (len(lines) - (lines[-1] = '')::INT)::BIGINT AS n
            FROM digests
        ), cut AS (
            SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                   CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                             OR h3 % 100 >= 100 THEN 'plain'
                        WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
            FROM drawn
        ), places AS (
            SELECT *, list_sum(list_transform(lines[1:a], lambda l: length(l) + 1)) AS p,
                   list_sum(list_transform(lines[1:b], lambda l: length(l) + 1)) AS q
            FROM cut
        ), parts AS (
            SELECT *, substr(text, 1, least(coalesce(p, 0), length(text))::BIGINT) AS prefix,
                   substr(text, 1, least(coalesce(q, 0), length(text))::BIGINT) AS most
            FROM places
        ), whole AS (
            SELECT *, substr(text, length(prefix) + 1, length(most) - length(prefix)) AS middle,
                   substr(text, length(most) + 1) AS suffix
            FROM parts
        )
        SELECT doc_id, n, form,
               CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text
                                WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                                ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM whole
    """,
}
