"""Shared by the operators of this package: table access, row keys and Arrow tasks."""

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from churnmart.session import materialize


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column="text"):
    """A NULL text counts as an empty one."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def with_row_key(df: DataFrame, key: str, label: str) -> DataFrame:
    """``df`` with a unique long per row, written so that every later pass sees the same keys.

    Ids of documents may be NULL or repeated; joins inside an operator use this key.
    """
    return materialize(df.withColumn(key, F.monotonically_increasing_id()), label)


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (column names ignore case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


def id_type(df: DataFrame, column: str) -> T.DataType:
    return df.schema[column].dataType


def arrow_map(df: DataFrame, schema: T.StructType, task) -> DataFrame:
    """``mapInArrow`` with ``task(iterator of column lists) -> iterator of column lists``.

    ``task`` gets and yields one list (or array) per column, for one Arrow batch at a time,
    so that a task holds a batch and never its partition.
    """
    out = to_arrow_schema(schema)

    def run(batches):
        read = ([c.to_pylist() for c in b.columns] for b in batches if b.num_rows)
        for columns in task(read):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(columns, out, strict=True)], schema=out
            )

    return df.mapInArrow(run, schema)


def slices(columns, rows):
    """A batch in pieces of at most ``rows`` rows: bounds what lies between text and result."""
    for at in range(0, len(columns[0]), rows):
        yield [c[at : at + rows] for c in columns]
