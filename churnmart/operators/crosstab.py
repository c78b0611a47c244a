"""Two-way tables. Pivot values are always given, so no extra job looks for them."""

from pyspark.sql import Column, DataFrame, functions as F

from churnmart.functions.exprs import col, share_pct


def rate_pivot(df: DataFrame, row: Column, row_name: str, column: Column, values: dict,
               flag="Exited") -> DataFrame:
    """Churn rate (percent, one digit) per row key and pivot value.

    ``values`` maps pivot values to output column names. NULL row keys are left out; a
    combination without rows is NULL.
    """
    churned = [
        share_pct(
            F.sum(F.when(column == v, col(flag))), F.count(F.when(column == v, col(flag))), 1
        ).alias(name)
        for v, name in values.items()
    ]
    return (
        df.where(row.isNotNull() & column.isNotNull())
        .groupBy(row.alias(row_name)).agg(*churned).orderBy(row_name)
    )


def count_pivot(df: DataFrame, row: str, column: str, values: dict, counted: str) -> DataFrame:
    """Non-NULL ``counted`` cells per row key and pivot value; NULL where there are none."""
    pivoted = (
        df.where(col(row).isNotNull())
        .groupBy(col(row)).pivot(column, list(values)).agg(F.count(col(counted)))
    )
    return pivoted.withColumnsRenamed({str(v): name for v, name in values.items()}).orderBy(row)
