"""A training corpus from ``documents``: filter, deduplicate, decontaminate, clean, pack.

Each stage takes (spark, docs, sf_dir) and returns documents with the columns it was given;
the last returns pieces of packed sequences. Rows with NULL or repeated ids and rows with
further columns pass through every stage; NULL texts count as empty ones.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnmart.llm import decontaminate, packing, secrets, simhash, toxicity
from churnmart.llm.common import fresh_name, read_table, with_row_key


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model does not grade as toxic."""
    model = toxicity.model_of(docs, read_table(spark, sf_dir, "labels"))
    return docs.where(toxicity.severity(docs, model)["p_toxic"] < toxicity.TOXIC_FROM)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies by SimHash: that of the smallest id."""
    key = fresh_name(docs, "row_key")
    return simhash.keep_one(with_row_key(docs, key, "documents"), key).drop(key)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    key = fresh_name(docs, "row_key")
    keyed = with_row_key(docs, key, "documents")
    return decontaminate.clean(keyed, read_table(spark, sf_dir, "benchmark"), key).drop(key)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked and ``n_chars`` of the new text."""
    masked = secrets.redact(docs, column=fresh_name(docs, "spans"))
    # A NULL text keeps the number it came with.
    size = F.coalesce(F.length("text"), F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return masked.withColumn("n_chars", size).select(*[f"`{c}`" for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces of sequences of at most 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("secret scans", mask_secrets),
    ("packing", pack_sequences),
]

# Models, component search and tokenisation have no SQL form; tests hold each stage against
# a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each over all rows that the one before kept."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
