"""Bank-shaped customer, product and transaction feeds over order-entry tables.

The given tables (region, nation, customer, part, orders, lineitem) hold no bank data.
These views derive the raw feeds from them with plain integer and date arithmetic.
"""

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from churnmart.functions.exprs import col
from churnmart.operators.joins import salted_join
from churnmart.operators.ordering import ranked_join, surrogate_key

# Identity of a transaction, and the order of the feed.
LINE_KEY = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity",
    "l_extendedprice",
)
SNAPSHOT_DATE = date(1999, 12, 31)
DIMENSION_LOAD = date(2000, 1, 1)
FEED_LOAD = date(2001, 8, 2)
DROPPED_EVERY = 97
MOVED_EVERY = 50
# Where a moved customer goes.
NEXT_REGION = {
    "Africa": "America",
    "America": "Asia",
    "Asia": "Europe",
    "Europe": "Middle East",
    "Middle East": "Africa",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_customers(spark: SparkSession, sf_dir: str, as_of: date | None = None) -> DataFrame:
    """Raw customer feed as known on ``as_of`` (all orders when None)."""
    orders = _table(spark, sf_dir, "orders").select(
        "o_custkey", col("o_orderdate").cast("date").alias("d"), "o_orderpriority"
    )
    if as_of is not None:
        orders = orders.where(F.col("d") <= F.lit(as_of))
    last_day = orders.select(F.max("d")).scalar()
    recent = F.date_diff(last_day, F.col("d")) <= 730
    # Copies of a hot customer collapse before each shuffle.
    per_customer = orders.groupBy("o_custkey").agg(
        F.date_diff(last_day, F.min("d")).alias("oldest"),
        F.date_diff(last_day, F.max("d")).alias("newest"),
        F.count_if(recent).alias("recent_orders"),
        F.count_distinct(F.when(recent, F.col("o_orderpriority"))).alias("priorities"),
    )
    places = _table(spark, sf_dir, "nation").join(
        _table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select("n_nationkey", "r_name")
    key = F.col("c_custkey")
    return (
        _table(spark, sf_dir, "customer")
        # Customers without an order stay, with no tenure and no activity.
        .join(per_customer, key == F.col("o_custkey"), "left")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            (key + 1).alias("RowNumber"),
            key.alias("CustomerId"),
            F.col("c_name").alias("Surname"),
            (300 + key * 37 % 551).cast("int").alias("CreditScore"),
            F.col("r_name").alias("Geography"),
            F.when(key % 2 == 0, "Female").otherwise("Male").alias("Gender"),
            (18 + key * 31 % 72).cast("int").alias("Age"),
            F.floor(F.col("oldest") / 365).cast("int").alias("Tenure"),
            (F.greatest(F.col("c_acctbal"), F.lit(0.0)) * 20)
            .cast("decimal(15,2)").cast("double").alias("Balance"),
            F.least(F.lit(4), F.greatest(F.lit(1), F.col("priorities")))
            .cast("int").alias("NumOfProducts"),
            (key % 10 < 7).cast("int").alias("HasCrCard"),
            (F.coalesce("recent_orders", F.lit(0)) >= 2).cast("int").alias("IsActiveMember"),
            (30000 + key * 7919 % 120000).cast("double").alias("EstimatedSalary"),
            F.coalesce(F.col("newest") > 365, F.lit(True)).cast("int").alias("Exited"),
            (key % 5 == 0).cast("int").alias("Complain"),
            (1 + key % 5).cast("int").alias("Satisfaction Score"),
            F.col("c_mktsegment").alias("Card Type"),
            (119 + key * 13 % 882).cast("int").alias("Point Earned"),
        )
    )


def dirty_customers(raw: DataFrame) -> DataFrame:
    """The raw feed with gaps, padded and mixed-case text, exact and re-keyed copies."""
    key = F.col("CustomerId")
    gaps = {
        "Balance": 17, "CreditScore": 19, "EstimatedSalary": 13, "Age": 23, "Tenure": 29,
        "HasCrCard": 31, "IsActiveMember": 37, "Geography": 41, "Gender": 43,
    }
    surname = F.concat(
        F.lit("\to'brien smith-jones "), (key % 7).cast("string"), F.lit("x ")
    )
    noisy = raw.withColumns({
        "Surname": F.when(key % 5 == 0, surname).otherwise(F.col("Surname")),
        "Geography": F.when(key % 3 == 0, F.concat(F.lit("  "), F.lower("Geography"), F.lit("\t")))
        .otherwise(F.col("Geography")),
        "Gender": F.when(key % 4 == 1, F.concat(F.lit("\t"), F.upper("Gender"), F.lit(" ")))
        .otherwise(F.col("Gender")),
    })
    gappy = noisy.withColumns({
        c: F.when(key % every != 0, col(c)) for c, every in gaps.items()
    })
    # 0 the row itself, 1 an exact copy, 2 a copy under another row number, 3 a copy whose
    # missing balance is filled in: the same row only after imputation.
    kinds = F.array_compact(F.array(
        F.lit(0), F.when(key % 50 == 0, F.lit(1)), F.when(key % 70 == 0, F.lit(2)),
        F.when(key % 34 == 0, F.lit(3)),
    ))
    rekeyed = F.col("kind") == 2
    return gappy.withColumn("kind", F.explode(kinds)).withColumns({
        "RowNumber": F.col("RowNumber") + F.when(rekeyed, 1_000_000_000).otherwise(0),
        "Balance": F.when(rekeyed, F.coalesce(F.col("Balance"), F.lit(0.0)) + 1000)
        .when(F.col("kind") == 3, F.lit(0.0)).otherwise(F.col("Balance")),
    }).drop("kind")


def incoming_customers(raw: DataFrame) -> DataFrame:
    """The later feed: all orders, and every 50th customer moved to the next region."""
    moved = F.col("Geography")
    chain = None
    for here, there in NEXT_REGION.items():
        at_home = (F.upper(moved) == here.upper(), F.lit(there))
        chain = F.when(*at_home) if chain is None else chain.when(*at_home)
    return raw.withColumn(
        "Geography", F.when(F.col("CustomerId") % MOVED_EVERY == 0, chain).otherwise(moved)
    )


def snapshot_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The earlier feed the dimension is first loaded from; some customers are not in it yet."""
    return raw_customers(spark, sf_dir, SNAPSHOT_DATE).where(
        F.col("CustomerId") % DROPPED_EVERY != 0
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product feed: one product per part type, numbered in name order."""
    names = _table(spark, sf_dir, "part").select(F.col("p_type").alias("product_name")).distinct()
    numbered = surrogate_key(names, "product_id", ["product_name"])
    n = F.col("product_id")
    return numbered.select(
        "product_id",
        "product_name",
        F.when(n % 3 == 1, "Deposit").when(n % 3 == 2, "Loan").otherwise("Credit")
        .alias("product_category"),
        (n * F.lit("1.25").cast("decimal(5,2)")).cast("decimal(5,2)").alias("interest_rate_pct"),
        F.lit(1).alias("is_active"),
        F.lit(2015).alias("launch_year"),
    )


def transactions(spark: SparkSession, sf_dir: str, raw: DataFrame,
                 product_feed: DataFrame) -> DataFrame:
    """Transaction feed: one row per order line, numbered in LINE_KEY order."""
    lines = _table(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_discount", "l_returnflag")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    parts = _table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    flags = raw.select(
        F.col("CustomerId").alias("o_custkey"), F.col("Exited").alias("churn_flag")
    )
    price = F.col("l_extendedprice").cast("decimal(15,2)")
    keep = 1 - F.col("l_discount").cast("decimal(4,2)")
    # Orders meet their customer first; a hot customer, order or part is spread by row hash.
    flagged = salted_join(orders, flags, "o_custkey", F.xxhash64("o_orderkey"))
    typed = salted_join(lines, parts, "l_partkey", F.xxhash64(*LINE_KEY), "inner")
    sold = typed.join(
        product_feed.select("product_id", "product_name"), F.col("p_type") == F.col("product_name")
    ).select(*LINE_KEY, "l_returnflag", "product_id", (price * keep).cast("decimal(15,2)").alias("amount"))
    # Lines are placed by their own keys and meet their order there: they are shuffled once.
    numbered = ranked_join(sold, flagged, "o_orderkey", LINE_KEY, "transaction_id", {
        "customer_id": F.col("o_custkey"),
        "transaction_date": F.col("l_shipdate").cast("date"),
        "transaction_type": F.col("l_returnflag"),
        "channel": F.col("o_orderpriority"),
        "product_id": F.col("product_id"),
        "amount": F.col("amount"),
        "churn_flag": F.col("churn_flag"),
    }, key_source=lines)
    return numbered.withColumns({
        "transaction_year": F.year("transaction_date"),
        "transaction_month": F.month("transaction_date"),
    })


def exit_survey(spark: SparkSession, sf_dir: str, raw: DataFrame) -> DataFrame:
    """Survey answers of churned customers: reason, and the month of their last order."""
    last = (
        _table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("customer_id"))
        .agg(F.max(F.col("o_orderdate").cast("date")).alias("last_day"))
    )
    churned = raw.where("Exited = 1").select(
        F.col("CustomerId").alias("customer_id")
    )
    number = (F.col("customer_id") % 7 + 1).cast("string")
    return churned.join(last, "customer_id", "left").select(
        "customer_id",
        F.concat(F.lit("Reason "), number).alias("churn_reason"),
        F.date_format("last_day", "yyyy-MM").alias("exit_month"),
    )

