"""One query per operator over the whole shared tables, and SQL where it can express the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellrank.llm.common import crc_of_id, table, whole_text
from dwellrank.llm.decontamination import find_passages
from dwellrank.llm.exact_dedup import duplicate_classes, older_half
from dwellrank.llm.jaccard_join import near_duplicate_counts
from dwellrank.llm.language_id import fit, identify
from dwellrank.llm.manifest import LOWER, UPPER, manifest, proof_digest, verified
from dwellrank.llm.ppm_scores import scored
from dwellrank.llm.secrets import scan_secrets
from dwellrank.llm.sentencepiece_scan import encode
from dwellrank.llm.sharding import assign
from dwellrank.llm.sql_twins import manifest_sql, url_models_sql
from dwellrank.llm.token_counts import token_counts
from dwellrank.llm.token_files import corpus_files
from dwellrank.llm.url_filter import Rule, filter_urls
from dwellrank.llm.whitening import whiten

SHARDS = 40

# The rules that URLs are judged by.
URL_RULES = [
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
]


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    sized = docs.withColumn("n_bytes", F.octet_length(whole_text()).cast("long")).select("doc_id", "text", "n_bytes")
    counted = token_counts(sized, tokenizer_file("word_bpe_49k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_classes(table(spark, sf_dir, "documents"), older_half())


def op4_secret_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_guess", "max_guess_cost"
    )


def op5_sentencepiece_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_file("piece_bpe_32k.model"))
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "round_trip", "ids")


def op6_jaccard_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_counts(table(spark, sf_dir, "documents"))


def op7_byte_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.pmod(crc_of_id(), F.lit(4)) == 2
    net = fit(docs, ~held_out)
    return identify(docs.select("doc_id", "text"), net).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_files(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op9_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = assign(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("position").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "vslot",
    )


def op10_partial_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.pmod(crc_of_id(), F.lit(10)) == 0
    found = scored(table(spark, sf_dir, "documents").select("doc_id", "text"), ~held_out)
    return found.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op11_url_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null doc_id has no decimal text, so its row is not tampered with."""
    docs = table(spark, sf_dir, "documents")
    hit = F.col("doc_id").isNotNull() & (F.pmod(crc_of_id(), F.lit(3)) == 0)
    rows = manifest(docs, tampered={"text": F.when(hit, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))})
    return verified(rows).select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root", "verified"
    )


def op13_exact_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_simhash_windows": op1_simhash_windows,
    "op2_token_counts": op2_token_counts,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_secret_costs": op4_secret_costs,
    "op5_sentencepiece_scan": op5_sentencepiece_scan,
    "op6_jaccard_regions": op6_jaccard_regions,
    "op7_byte_network": op7_byte_network,
    "op8_token_files": op8_token_files,
    "op9_virtual_slots": op9_virtual_slots,
    "op10_partial_matching": op10_partial_matching,
    "op11_url_models": op11_url_models,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_exact_whitening": op13_exact_whitening,
}

ORACLES = {
    "op3_exact_dedup": """
        select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(body) as text_sha256
        from (
            select doc_id, body, max(doc_id) over (partition by body) as keep_id,
                count(*) over (partition by body) as group_size
            from (select doc_id, coalesce(text, '') as body from documents)
        )
    """,
    "op11_url_models": url_models_sql(),
    "op12_merkle_manifest": manifest_sql(),
}
