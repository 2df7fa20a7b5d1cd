"""The registered queries over the benchmark tables: each operator with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataline.llm import divergence, licenses, resampling, url_filter
from strataline.sources.tables import literal_table



def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str, tokenizer: str = "word_bpe_49k.json") -> DataFrame:
    """Every piece of every document with its place in a packed sequence."""
    from strataline.llm.packing import pack_documents

    pieces = pack_documents(table(spark, sf_dir, "documents"), tokenizer, end_id=1)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class of near-copies and its number of links."""
    from strataline.llm.jaccard import jaccard_join

    return jaccard_join(table(spark, sf_dir, "documents"))


def op3_token_files(spark: SparkSession, sf_dir: str, tokenizer: str = "byte_bpe_50k.json") -> DataFrame:
    """Every document as read back from the written token files."""
    from strataline.llm.token_files import read_token_files, write_token_files

    files = write_token_files(table(spark, sf_dir, "documents"), tokenizer, end_id=2)
    return read_token_files(spark, files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its toxicity score."""
    from strataline.llm.toxicity import score_toxicity

    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its importance weight, and whether the resampling keeps it."""
    from strataline.llm.quality import select_quality

    return select_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_near_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with its links and its component."""
    from strataline.llm.embeddings import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its places of license phrases and its labels."""
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its spans of personal data."""
    from strataline.llm.pii import KINDS, find_personal_data

    found = find_personal_data(table(spark, sf_dir, "documents"))
    count = lambda kind: F.regexp_count("base", F.lit(f"{kind}:")).cast("long").alias(f"n_{kind}")
    n_spans = F.when(F.col("spans") == "", 0).otherwise(F.regexp_count("spans", F.lit(",")) + 1).cast("long").alias("n_spans")
    return found.select("doc_id", *(count(k) for k in KINDS), F.sha2("base", 256).alias("base_sha256"), "spans", n_spans)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as read back from the written archives."""
    from strataline.llm.warc import read_archives, write_archives

    archives = write_archives(table(spark, sf_dir, "pages"))
    return read_archives(spark, archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every overlap of a document with a benchmark item."""
    from strataline.llm.decontaminate import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row_key")


def op11_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the sources of each language differ: every pair of them, and each one's own terms."""
    return divergence.divergence(table(spark, sf_dir, "documents"))


def op12_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page with the rule that decides about its URL, and the verdict."""
    rules = literal_table(spark, url_filter.RULES, "host string, path string, verdict string")
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), rules)


def op13_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its weight towards the benchmark texts, and its rank if it is drawn."""
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_token_files": op3_token_files,
    "op4_toxicity": op4_toxicity,
    "op5_quality": op5_quality,
    "op6_near_embeddings": op6_near_embeddings,
    "op7_licenses": op7_licenses,
    "op8_personal_data": op8_personal_data,
    "op9_warc": op9_warc,
    "op10_decontamination": op10_decontamination,
    "op11_divergence_audit": op11_divergence_audit,
    "op12_url_filters": op12_url_filters,
    "op13_target_resampling": op13_target_resampling,
}

ORACLES: dict[str, str] = {
    "op7_licenses": licenses.oracle(),
    "op11_divergence_audit": divergence.oracle(),
    "op12_url_filters": url_filter.oracle(),
    "op13_target_resampling": resampling.oracle(),
}
