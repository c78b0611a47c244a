"""Column expressions. All of them stay inside whole-stage code generation."""

from functools import reduce

from pyspark.sql import Column, functions as F

from churnmart.constants import (
    MODERATE_CORRELATION,
    STRONG_CORRELATION,
    Bands,
)


def col(name: str) -> Column:
    """A column by its literal name, also when the name holds spaces or dots."""
    return F.col(f"`{name}`")


def quoted(names) -> list:
    """Literal column names for select and groupBy; cheaper to build than Columns."""
    return [f"`{n}`" for n in names]


def bin_label(value: Column, bands: Bands, include_lowest=False) -> Column:
    """Label of the right-closed interval that holds ``value``; NULL outside of all."""
    chain = None
    for i, label in enumerate(bands.labels):
        low, high = bands.edges[i], bands.edges[i + 1]
        above = value >= low if include_lowest and i == 0 else value > low
        branch = (above & (value <= high), F.lit(label))
        chain = F.when(*branch) if chain is None else chain.when(*branch)
    return chain


def map_label(value: Column, labels: dict) -> Column:
    """Dictionary lookup with NULL for unmapped keys."""
    chain = None
    for key, label in labels.items():
        branch = (value == key, F.lit(label))
        chain = F.when(*branch) if chain is None else chain.when(*branch)
    return chain


def strip_ws(value: Column) -> Column:
    """Remove leading and trailing white space of every kind, not only spaces."""
    return F.regexp_replace(value, r"^\s+|\s+$", "")


def title_case(value: Column) -> Column:
    """Upper case for each letter that follows a non-letter, lower case elsewhere."""
    def joined(at):
        return F.array_join(F.transform(F.split(F.lower(value), at), F.initcap), "")

    # Of plain text fewer pieces will do: none for words between spaces, else one per word.
    return (
        F.when(value.rlike(r"\A[A-Za-z ]*\z"), F.initcap(value))
        .when(value.rlike(r"\A[\x00-\x7F]*\z"), joined(r"(?<=[^a-z])(?=[a-z])"))
        .otherwise(joined(r"(?<=[^\p{L}])|(?=[^\p{L}])"))
    )


def round_even(value: Column, digits: int) -> Column:
    """Scale, round half to even, scale back: the rounding of binary-float data frames."""
    factor = float(10**digits)
    return F.rint(value.cast("double") * F.lit(factor)) / F.lit(factor)


def clip(value: Column, low, high) -> Column:
    """Limit to ``[low, high]`` and keep NULL as NULL."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def add_up(terms) -> Column:
    return reduce(lambda a, b: a + b, terms)


def rate_pct(part: Column, whole: Column, digits=2) -> Column:
    """``part * 100 / whole`` in DECIMAL, rounded half up; NULL for an empty whole."""
    exact = F.try_divide(part.cast("decimal(20,0)") * 100, whole.cast("decimal(20,0)"))
    return F.round(exact, digits).cast("double")


def share_pct(part: Column, whole: Column, digits: int) -> Column:
    """``part / whole * 100`` in binary floats, rounded half to even."""
    return round_even(F.try_divide(part.cast("double"), whole.cast("double")) * 100, digits)


def money(value: Column, digits=2) -> Column:
    """Round a DECIMAL half up and leave as a double for the report."""
    return F.round(value, digits).cast("double")


def adjusted_skew(rows: Column, skewness: Column, constant: Column) -> Column:
    """Bias-corrected sample skewness from the plain one; NULL below three values, 0 for a constant."""
    n = rows.cast("double")
    factor = F.try_divide(F.sqrt(n * (n - 1)), n - 2)
    return F.when(n < 3, F.lit(None)).when(constant, F.lit(0.0)).otherwise(skewness * factor)


def correlation_label(value: Column) -> Column:
    strength = (
        F.when(F.abs(value) > STRONG_CORRELATION, "strong")
        .when(F.abs(value) > MODERATE_CORRELATION, "moderate")
        .otherwise("weak")
    )
    direction = F.when(value > 0, "positive").otherwise("negative")
    return F.concat_ws(" ", strength, direction)


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


# Exact distinct counts of dense integer keys: per group one row for each bucket of 32768 keys,
# with a bitmap of those present. Bitmaps combine before a shuffle.
KEY_BUCKET, KEY_BITS = "__bucket", "__bits"


def key_bucket(key: str) -> Column:
    """The bucket of a key, to group by; NULL keys have a bucket of their own without bits."""
    return F.bitmap_bucket_number(col(key)).alias(KEY_BUCKET)


def key_bits(key: str) -> Column:
    return F.bitmap_construct_agg(F.bitmap_bit_position(col(key))).alias(KEY_BITS)


def count_bits() -> Column:
    """Distinct keys of a group, over its buckets."""
    return F.sum(F.bitmap_count(KEY_BITS))
