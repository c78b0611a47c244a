"""Declared table layouts and the one cast step before a table is written."""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T

from churnmart.functions.exprs import add_up, col, nan_to_null

RAW_CUSTOMERS = (
    "RowNumber BIGINT, CustomerId BIGINT, Surname STRING, CreditScore INT, Geography STRING, "
    "Gender STRING, Age INT, Tenure INT, Balance DOUBLE, NumOfProducts INT, HasCrCard INT, "
    "IsActiveMember INT, EstimatedSalary DOUBLE, Exited INT, Complain INT, "
    "`Satisfaction Score` INT, `Card Type` STRING, `Point Earned` INT"
)

STAGED_CUSTOMERS = (
    "customer_sk BIGINT, customer_id BIGINT, surname STRING, credit_score DOUBLE, "
    "geography STRING, gender STRING, age INT, tenure INT, balance DOUBLE, "
    "num_of_products INT, has_cr_card INT, is_active_member INT, estimated_salary DOUBLE, "
    "churn_flag INT, Complain INT, `Satisfaction Score` INT, `Card Type` STRING, "
    "`Point Earned` INT, age_group STRING, credit_tier STRING, tenure_band STRING, "
    "high_value_flag STRING, estimated_ltv DOUBLE, churn_label STRING, "
    "balance_salary_ratio DOUBLE, product_engagement INT, risk_score INT, "
    "risk_category STRING, effective_start_date DATE, effective_end_date DATE, "
    "is_current INT, record_version INT"
)


@dataclass(frozen=True)
class Table:
    """Column types, plus what a missing or NULL value becomes and must never be."""

    ddl: str
    not_null: tuple = ()
    defaults: dict = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)


DIM_CUSTOMER = Table(
    "customer_sk BIGINT, customer_id BIGINT, surname STRING, credit_score INT, "
    "geography STRING, gender STRING, age INT, tenure INT, balance DECIMAL(15,2), "
    "num_of_products INT, has_cr_card INT, is_active_member INT, "
    "estimated_salary DECIMAL(15,2), churn_flag INT, age_group STRING, credit_tier STRING, "
    "tenure_band STRING, high_value_flag STRING, estimated_ltv DECIMAL(15,2), "
    "churn_label STRING, balance_salary_ratio DECIMAL(10,4), product_engagement INT, "
    "risk_score INT, risk_category STRING, effective_start_date DATE, "
    "effective_end_date DATE, is_current INT, record_version INT, created_at TIMESTAMP, "
    "Complain INT, `Satisfaction Score` INT, `Card Type` STRING, `Point Earned` INT",
    not_null=("customer_sk", "customer_id", "churn_flag", "effective_start_date",
              "effective_end_date", "is_current"),
    defaults={
        "churn_flag": lambda: F.lit(0),
        "high_value_flag": lambda: F.lit("N"),
        "effective_end_date": lambda: F.lit("9999-12-31"),
        "is_current": lambda: F.lit(1),
        "record_version": lambda: F.lit(1),
        "created_at": F.current_timestamp,
    },
)
DIM_PRODUCT = Table(
    "product_sk BIGINT, product_id BIGINT, product_name STRING, product_category STRING, "
    "interest_rate_pct DECIMAL(5,2), is_active INT, launch_year INT",
    not_null=("product_sk", "product_id"),
    defaults={"is_active": lambda: F.lit(1)},
)
DIM_DATE = Table(
    "date_sk INT, full_date DATE, year INT, quarter INT, month INT, month_name STRING, "
    "month_short STRING, week_no INT, day_of_month INT, day_of_week_no INT, "
    "day_name STRING, is_weekend INT, is_month_start INT, is_month_end INT, "
    "year_month STRING, year_quarter STRING",
    not_null=("date_sk", "full_date"),
)
DIM_CHURN_REASON = Table(
    "churn_reason_sk BIGINT, customer_id BIGINT, churn_flag INT, churn_reason STRING, "
    "exit_month STRING",
    not_null=("churn_reason_sk", "customer_id"),
)
FACT_TRANSACTIONS = Table(
    "transaction_sk BIGINT, transaction_id BIGINT, customer_sk BIGINT, product_sk BIGINT, "
    "date_sk INT, customer_id BIGINT, transaction_date DATE, transaction_year INT, "
    "transaction_month INT, transaction_type STRING, channel STRING, amount DECIMAL(15,2), "
    "churn_flag INT",
    not_null=("transaction_sk", "transaction_id"),
    defaults={"churn_flag": lambda: F.lit(0)},
)


def _cast(value: Column, source: T.DataType, target: T.DataType) -> Column:
    if isinstance(target, T.IntegerType) and isinstance(source, (T.DoubleType, T.FloatType)):
        # Loading a fractional number into an integer column rounds it, half away from zero.
        value = F.round(value)
    return value.cast(target)


def enforce_schema(df: DataFrame, table: Table) -> DataFrame:
    """Declared columns in declared order and type; missing ones become default or NULL."""
    present = {f.name: f.dataType for f in df.schema}
    out = []
    for f in table.schema:
        if f.name in present:
            value = _cast(col(f.name), present[f.name], f.dataType)
        else:
            value = F.lit(None).cast(f.dataType)
        if f.name in table.defaults:
            value = F.coalesce(value, table.defaults[f.name]().cast(f.dataType))
        out.append(value.alias(f.name))
    return df.select(*out)


def not_null_violations(df: DataFrame, table: Table) -> DataFrame:
    """Rows ``(column, nulls)`` for the declared NOT NULL columns, in one pass."""
    counts = df.agg(*[F.count_if(col(c).isNull()).alias(c) for c in table.not_null])
    return counts.select(
        F.inline(F.array(*[
            F.struct(F.lit(c).alias("column"), col(c).alias("nulls")) for c in table.not_null
        ]))
    )


def require_not_null(df: DataFrame, table: Table) -> DataFrame:
    """``df`` with a check that fails the job on a NULL in a NOT NULL column.

    The check rides along with the write (no pass of its own).
    """
    broken = add_up([F.when(col(c).isNull(), 1).otherwise(0) for c in table.not_null])
    first = table.not_null[0]
    message = F.lit("NULL in a NOT NULL column")
    checked = F.when(broken == 0, col(first)).otherwise(F.raise_error(message).cast("bigint"))
    kind = df.schema[first].dataType
    return df.withColumn(first, checked.cast(kind))


def clean_numbers(df: DataFrame) -> DataFrame:
    """NaN in floating columns becomes NULL, the one kind of missing value from here on."""
    return df.select(*[
        nan_to_null(col(f.name)).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else col(f.name)
        for f in df.schema
    ])
