"""A pipeline that turns raw documents into training text, one operator per stage.

Every stage takes all that its predecessor kept and decides by the operator's own rules. Decisions are made
for texts and for rows, never for a doc_id alone: rows that share a doc_id, or have none, are rows of their own.
Of equal rows the smallest in order of all columns stays, which is any of them when they are equal throughout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellrank.llm.common import crc_of_id, table, whole_text
from dwellrank.llm.decontamination import find_passages
from dwellrank.llm.exact_dedup import duplicate_classes, older_half
from dwellrank.llm.jaccard_join import near_duplicate_classes
from dwellrank.llm.language_id import UNKNOWN, fit, identify
from dwellrank.llm.queries import tokenizer_file
from dwellrank.llm.sentencepiece_scan import encode
from dwellrank.operators.joins import with_keys, without_keys
from dwellrank.session import pin

LEAST_SCORE = 0.34  # a best language with no more than a third of the probability is none
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = "4m"  # of a batch that goes to Python; Spark's own 64 MB are held by the executor and the worker of each task


def _small_batches(spark: SparkSession) -> bool:
    """Bound the batches that go to Python, unless the session has a bound of its own; whether this set one.

    Results are computed after a stage returns, so the setting stays in the session; ``run`` takes it back.
    """
    unset = spark.conf.get(BATCH, None) is None
    if unset:
        spark.conf.set(BATCH, BATCH_BYTES)
    return unset


def _text_key() -> Column:
    return F.sha2(whole_text(), 256)


def _one_row_each(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of rows with equal ``keys`` the smallest; tasks keep one row per key before anything moves."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_least")).select("_least.*")


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language stay; those without any letter go, and those which the network gives no
    language more than ``LEAST_SCORE``. The network learns as in its query; where there is nothing to learn
    from, every text with a letter stays.
    """
    _small_batches(spark)
    net = fit(docs, F.pmod(crc_of_id(), F.lit(4)) != 2)
    if net is None:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    own = {c: f"_own_{c}" for c in ("lang_pred", "score") if c in docs.columns}
    judged = identify(docs.withColumnsRenamed(own), net)
    known = judged.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") > LEAST_SCORE)).drop("lang_pred", "score")
    return known.withColumnsRenamed({v: k for k, v in own.items()}).select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, one row with the largest doc_id stays; ids come before null."""
    copies = duplicate_classes(docs.select("doc_id", "text"), older_half()).filter("group_size > 1")
    groups = pin(copies.select(F.col("text_sha256").alias("_key"), "keep_id").distinct(), "copied-texts")
    keyed = docs.withColumn("_key", _text_key())
    single = without_keys(keyed, groups.select("_key"), "_key").select(*docs.columns)
    # Structs are equal when the ids in them are both null.
    stays = groups.select(F.struct("_key", F.col("keep_id").alias("doc_id")).alias("_row_key"))
    kept = with_keys(keyed.withColumn("_row_key", F.struct("_key", "doc_id")), stays, "_row_key")
    return single.unionByName(_one_row_each(kept.drop("_row_key"), ["_key"]).select(*docs.columns))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links connect, one row with the smallest doc_id stays; ids come before null."""
    _small_batches(spark)
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.xxhash64(whole_text()).alias("text"))
    classes = near_duplicate_classes(docs.select(key.alias("doc_id"), "text"))
    named = pin(
        classes.groupBy(F.col("doc_id").alias("_named"))
        .agg(F.any_value("component_id").alias("first"), F.count("*").alias("rows"), F.any_value("n_shingles").alias("n_shingles"))
        .withColumn("stays", F.col("_named") == F.col("first"))
        .filter("not stays or rows > 1 and n_shingles > 0"),
        "near-classes",
    )
    # Rows whose key is not the first of its class go, and of equal rows with the first key all but one.
    keyed = docs.withColumn("_key", key)
    left = without_keys(keyed, named.select(F.col("_named").alias("_key")), "_key").select(*docs.columns)
    again = with_keys(keyed, named.filter("stays").select(F.col("_named").alias("_key")), "_key")
    return left.unionByName(_one_row_each(again, ["_key"]).select(*docs.columns))


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a passage of the benchmark was found go, whatever their doc_id."""
    texts = docs.select(_text_key().alias("doc_id"), "text")
    found = pin(find_passages(texts, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("_key")).distinct(), "leaked-texts")
    return without_keys(docs.withColumn("_key", _text_key()), found, "_key").select(*docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All columns, the ids of the text, and whether decoding gives it back."""
    _small_batches(spark)
    return encode(docs, tokenizer_file("piece_bpe_32k.model"))


STAGES = [
    ("language_id", keep_known_languages),
    ("exact_dedup", drop_exact_copies),
    ("jaccard_join", keep_one_of_near_copies),
    ("decontamination", drop_benchmark_passages),
    ("sentencepiece", encode_pieces),
]

# No SQL can express the trained network and the tokenizer; tests compare run() with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs, unset = table(spark, sf_dir, "documents"), _small_batches(spark)
    try:
        for name, stage in STAGES:
            docs = pin(stage(spark, docs, sf_dir), f"pipeline-{name}")
    finally:
        if unset:
            spark.conf.unset(BATCH)
    return docs
