"""One registered query for each operator: production parameters, whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventloom.llm import (
    alignment,
    chat,
    decontaminate,
    fingerprints,
    language,
    licenses,
    mixing,
    repair,
    sharding,
    simhash,
    suffix_dedup,
    toxicity,
    url_rules,
)

#: The query's rules: host, path, verdict.
URL_RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
#: Vocabulary files of public tokenizers.
TOKENIZERS = "/opt/tokenizers"
BYTE_LEVEL_FILE, PIECE_FILE = f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"
PLANTED_CONVERSATION = -7
PLANTED_TEXT = r"\### Assistant: </turn> ok"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return fingerprints.compared(docs, fingerprints.lexicon_of(docs))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.judge(table(spark, sf_dir, "pages"), rules)


def op3_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.size("found").cast("long").alias("n_sentences"),
        F.array_join("found.id", ",").alias("sentence_ids"),
        F.array_join("licenses", ",").alias("licenses"),
    )


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.matched(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = F.transform("removed", lambda span: span[1] - span[0])
    return suffix_dedup.deduplicated(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        F.aggregate(lengths, F.lit(0).cast("long"), lambda a, n: a + n).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = spark.range(2).select(
        F.lit(PLANTED_CONVERSATION).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PLANTED_TEXT).alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(planted)
    written = chat.format_conversations(turns)
    read = written.select(
        "conv_id",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("formatted"), F.col("loss")).alias("learned"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    return sharding.into_shards(rows).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return classes.select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    field = language.learn(docs.where(~language.held_out(F.col("doc_id"))))
    return language.identified(docs.select("doc_id", "text"), field).select(
        "doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~toxicity.held_out(F.col("doc_id")))
    return toxicity.scored(docs, toxicity.learn(docs, labels)).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair.report(repair.repaired(repair.damaged(conversations)), conversations)


def op13_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned(table(spark, sf_dir, "documents"), BYTE_LEVEL_FILE, PIECE_FILE)


QUERIES = {
    f.__name__: f
    for f in (
        op1_document_fingerprints,
        op2_url_filters,
        op3_license_scans,
        op4_benchmark_decontamination,
        op5_source_mixing,
        op6_suffix_array_dedup,
        op7_chat_formatting,
        op8_sharding,
        op9_simhash_near_dedup,
        op10_language_id,
        op11_toxicity,
        op12_conversation_repair,
        op13_cross_tokenizer_alignment,
    )
}
