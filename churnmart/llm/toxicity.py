"""Toxicity: cumulative-link ordinal regression of severity grades on sparse text features.

P(grade >= k) = sigmoid(w.x - threshold k): one set of weights, ordered thresholds. Weights
are learnt with follow-the-regularised-leader steps, thresholds with gradient steps on the
first threshold and the logarithms of the gaps, which keeps them in order.
"""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnmart.llm.linear import Ftrl, WordStems, fit, labelled_sample, sigmoid, sums

# Labelled documents a model learns from at most, and how often it sees each.
SAMPLE_ROWS = 20_000
EPOCHS = 6
GRADES = 3
# A document is toxic from this probability of a grade over 0 on.
TOXIC_FROM = 0.3
# A feature marks toxic text if so many toxic examples have it and its share among them is
# so many times its share among the others.
MARK_ROWS, MARK_LIFT = 5, 20


def grades_of(xs, toxic):
    """Grade 0 without the label; labelled texts are 1, and 2 with more marks than the median.

    The labels only say yes or no. How many features of a labelled text hardly occur
    elsewhere orders the labelled ones.
    """
    toxic = np.asarray(toxic) > 0
    size = int(max((at.max() for at, _ in xs), default=0)) + 1
    have = [np.zeros(size), np.zeros(size)]
    for (at, _), y in zip(xs, toxic):
        have[int(y)][at] += 1
    share = [h / max(1, n) for h, n in zip(have, (np.sum(~toxic), np.sum(toxic)))]
    marks = (have[1] >= MARK_ROWS) & (share[1] >= MARK_LIFT * share[0])
    counts = np.array([marks[at].sum() for at, _ in xs])
    middle = np.median(counts[toxic]) if toxic.any() else 0
    return np.where(toxic, 1 + (counts > middle), 0)


def thresholds_of(first, gaps):
    return first + np.concatenate(([0.0], np.cumsum(np.exp(gaps))))


def fit_ordinal(xs, grades, n_grades, epochs=EPOCHS):
    """(weights, thresholds) of a cumulative-link model."""
    # No weight is negative: nothing that a long text also says makes an insult milder.
    model = Ftrl(alpha=0.3, beta=1.0, l1=2.0, l2=0.1, least=0.0)
    first, gaps = 1.0, np.zeros(n_grades - 2)
    squares = np.full(n_grades - 1, 1e-8)
    for _ in range(epochs):
        for (at, value), grade in zip(xs, grades):
            w = model.weights(at)
            w[at == 0] = 0
            over = sigmoid(w @ value - thresholds_of(first, gaps))
            upper = over[grade - 1] if grade else 1.0
            lower = over[grade] if grade < n_grades - 1 else 0.0
            model.update(at[:-1], (upper + lower - 1) * value[:-1], w[:-1])
            slope = np.zeros(n_grades - 1)
            chance = max(upper - lower, 1e-9)
            if grade:
                slope[grade - 1] += upper * (1 - upper) / chance
            if grade < n_grades - 1:
                slope[grade] -= lower * (1 - lower) / chance
            # By the first threshold and by each gap: all thresholds after it move along.
            tail = np.cumsum(slope[::-1])[::-1]
            step = np.concatenate(([tail[0]], tail[1:] * np.exp(gaps)))
            squares += step**2
            step *= 0.1 / np.sqrt(squares)
            first, gaps = first - step[0], gaps - step[1:]
    weights = model.dense()
    weights[0] = 0
    return weights, thresholds_of(first, gaps)


def _learn(xs, toxic):
    return fit_ordinal(xs, grades_of(xs, toxic), GRADES)


def model_of(docs: DataFrame, labels: DataFrame, sample_rows=SAMPLE_ROWS, where=None):
    """(weights, thresholds) learnt from at most ``sample_rows`` labelled documents."""
    weights, thresholds = fit(labelled_sample(docs, labels, "toxic", WordStems, sample_rows, where), _learn)
    if not len(thresholds):
        thresholds = np.arange(1.0, GRADES)
    return weights, thresholds


def severity(docs: DataFrame, model, text_col="text"):
    """Struct column: p_toxic, severity (the expected grade), grade (the likeliest)."""
    weights, thresholds = model
    z = sums(docs, weights, WordStems, text_col)
    return F.transform(F.array(z), lambda z: _parts(z, thresholds))[0]


def _parts(z, thresholds):
    over = [1 / (1 + F.exp(F.lit(float(t)) - z)) for t in thresholds]
    chance = [a - b for a, b in zip([F.lit(1.0), *over], [*over, F.lit(0.0)])]
    best = F.array_max(F.array(*[F.struct(c.alias("c"), F.lit(-k).alias("k")) for k, c in enumerate(chance)]))
    return F.struct(over[0].alias("p_toxic"), sum(over[1:], over[0]).alias("severity"), (-best["k"]).alias("grade"))


def score(docs: DataFrame, labels: DataFrame, sample_rows=SAMPLE_ROWS, where=None) -> DataFrame:
    """doc_id, severity, grade, p_toxic and toxic (1 if p_toxic >= TOXIC_FROM) for every row.

    NULL texts are empty ones: no features, the lowest score the model gives. NULL or
    repeated ids keep their rows; repeated rows get equal scores. Without usable labels the
    weights are zero and nothing is toxic. An empty table gives no rows. Columns other than
    doc_id and text are not read.
    """
    found = severity(docs, model_of(docs, labels, sample_rows, where))
    rows = docs.select("doc_id", found.alias("s"))
    toxic = (F.col("s.p_toxic") >= TOXIC_FROM).cast("int").alias("toxic")
    return rows.select("doc_id", "s.severity", "s.grade", "s.p_toxic", toxic)
