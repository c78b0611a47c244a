"""Quality classifier: logistic regression on hashed word n-grams, trained with FTRL."""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnmart.llm.linear import Ftrl, WordNgrams, fit, labelled_sample, sigmoid, sums

# Labelled documents a model learns from at most, and how often it sees each.
SAMPLE_ROWS = 20_000
EPOCHS = 4


def _learn(xs, ys):
    model = Ftrl(alpha=0.5, beta=1.0, l1=0.3, l2=0.5)
    for _ in range(EPOCHS):
        for (at, value), y in zip(xs, ys):
            w = model.weights(at)
            model.update(at, (sigmoid(w @ value) - (y > 0)) * value, w)
    return model.dense(), []


def fold(id_col="doc_id"):
    """crc32 of the id as text, modulo 3; fold 1 is held out."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3


def score(docs: DataFrame, labels: DataFrame, sample_rows=SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``.

    Learns from at most ``sample_rows`` rows of ``labels`` outside fold 1 and scores every
    whole text. NULL texts are empty ones and get the score of a text without words. Rows
    with NULL ids are scored and not held out. Repeated rows get equal scores, repeated
    labels count as often as they occur. Without usable labels each score is 0.5. An empty
    table gives no rows. Columns other than doc_id and text are not read.
    """
    sample = labelled_sample(docs, labels, "quality", WordNgrams, sample_rows, fold() != 1)
    weights, _ = fit(sample, _learn)
    rows = docs.select(
        "doc_id",
        F.coalesce(fold() == 1, F.lit(False)).alias("held_out"),
        sums(docs, weights, WordNgrams).alias("z"),
    )
    likely = 1 / (1 + F.exp(-F.col("z")))
    return rows.select("doc_id", "held_out", likely.alias("score"), (likely >= 0.5).cast("int").alias("predicted"))
