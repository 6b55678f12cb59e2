"""Corpus pipeline: documents in, packed training sequences out.

Every stage takes all rows its predecessor wrote and is written and read again, so a lost executor
costs at most the stage it is lost in.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.llm import decontaminate, languages, near_copies, packing, secrets
from skyloom.llm.common import for_texts
from skyloom.sources.lake import staged

#: Words a worker remembers while packing: fewer than in op1, as executors have run four stages before.
CACHED_WORDS = 50_000


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language go on, with its name where they had none; those without a letter
    go. Learns from all labels there are."""
    found = languages.identify(docs, F.lit(True)).filter(F.col("lang_pred") != "und")
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, a Jaccard similarity of 0.8
    or more) goes on."""
    return near_copies.distinct_documents(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item go on."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents go on, the values of secrets replaced and lengths brought up to date."""
    found = secrets.scan(docs)
    found = found.withColumn("n_chars", F.when(F.size("findings") > 0, F.length("redacted")).otherwise(F.col("n_chars")))
    return found.withColumn("text", F.col("redacted")).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences with their token ids."""
    from public_tokenizers import path

    return packing.pack(docs, path("word_bpe_49k.json"), cached=CACHED_WORDS)


STAGES = [
    ("language", for_texts(identify_language)),
    ("near_duplicates", for_texts(drop_near_duplicates)),
    ("decontaminate", for_texts(drop_contaminated)),
    ("secrets", for_texts(redact_secrets)),
    ("packing", for_texts(pack_sequences)),
]
#: Two stages learn models, which SQL cannot; tests/llm holds run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
