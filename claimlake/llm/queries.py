"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat, collocations, decontaminate, exact_dedup, html_extract, lexical_search, mixing, secrets, simhash, suffix_dedup, toxicity,
               url_filter, warc)
from .common import table

PROBE = "\\### Assistant: </turn> ok"


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations plus -7, whose turns look like control strings; read back from the output."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], turns.schema)
    return chat.read_back(chat.format_conversations(turns.unionByName(probe)))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.by_position(mixing.mix_sources(table(spark, sf_dir, "documents"))).select(
        "doc_id", "size", "source_size", "target", "taken")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def learnable(labels: DataFrame) -> DataFrame:
    """Labels of the rows that may be learnt from."""
    return labels.filter(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train_toxicity(docs, learnable(table(spark, sf_dir, "labels")))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return (toxicity.score_toxicity(docs.select("doc_id", "text"), model)
            .select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    kind = pages.schema["page_id"].dataType
    return warc.read_warc(warc.write_warc(pages)).select(
        F.col("page").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = [r.kind for r in secrets.BASE_RULES]
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    own = F.filter("found", lambda s: s["kind"].isin(base))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in base], F.sha2(listed(own), 256).alias("base_sha256"),
                        listed(F.col("found")).alias("spans"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_verdicts(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine_phrases(table(spark, sf_dir, "documents"))


def op13_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = html_extract.extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return text.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_chat_format, op2_mix_sources, op3_decontaminate, op4_simhash_dedup, op5_suffix_dedup, op6_toxicity,
    op7_warc, op8_exact_dedup, op9_secret_scan, op10_url_filter, op11_lexical_search, op12_collocations,
    op13_html_extract, pipeline)}
