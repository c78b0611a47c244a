"""Scans with an explicit schema; nothing is inferred from the data."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from churnmart.schemas import RAW_CUSTOMERS, STAGED_CUSTOMERS, clean_numbers


# What a published table says about itself: a rising number and the folder of its files.
PUBLISHED = "number LONG, folder STRING"


def published_versions(spark: SparkSession, path: str) -> list:
    """(number, folder) of every table published at ``path``, the current one last."""
    try:
        notes = spark.read.schema(PUBLISHED).parquet(f"{path}/published")
        return [tuple(r) for r in notes.orderBy("number", "folder").collect()]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def published(spark: SparkSession, path: str) -> str:
    """The folder that holds the current table at ``path``, see ``writers.publish_files``."""
    versions = published_versions(spark, path)
    if not versions:
        raise FileNotFoundError(f"nothing published at {path}")
    return f"{path}/{versions[-1][1]}"


def read_table(spark: SparkSession, path: str, schema, fmt=None) -> DataFrame:
    """CSV with header or Parquet by file ending (or ``fmt``); a bad CSV cell fails the read.

    A missing path fails at once, with the path in the message.
    """
    fmt = fmt or ("csv" if path.rstrip("/").endswith(".csv") else "parquet")
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = (
            reader.option("header", True)
            .option("enforceSchema", False)
            .option("nullValue", "")
            .option("mode", "FAILFAST")
            .option("escape", '"')
            .option("multiLine", False)
        )
    elif fmt != "parquet":
        raise ValueError(f"unknown table format: {fmt}")
    return reader.format(fmt).load(path)


def read_raw_customers(spark: SparkSession, path: str, fmt=None, schema=RAW_CUSTOMERS) -> DataFrame:
    return clean_numbers(read_table(spark, path, schema, fmt))


def read_staged_customers(spark: SparkSession, path: str, fmt=None) -> DataFrame:
    return read_table(spark, path, STAGED_CUSTOMERS, fmt)


def run_sql(spark: SparkSession, tables: dict, text: str, args: dict | None = None) -> DataFrame:
    """SQL text over tables named in braces, ``FROM {fact_transactions} f``; errors reach the caller.

    ``tables`` maps names to DataFrames, for this call only: the session's own views are
    neither read nor replaced. ``args`` are parameters, ``:name`` in the text.
    """
    used = {name: table for name, table in tables.items() if "{" + name + "}" in text}
    return spark.sql(text, args, **used)
