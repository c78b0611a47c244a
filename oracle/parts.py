"""Building blocks of the check queries: expressions and common table expressions.

Written for DuckDB, on the given tables only. Numbers with ``e0`` are DOUBLE literals (a
plain decimal literal would be DECIMAL).
"""


def rint(y):
    """Round half to even."""
    return (f"list_transform([{y}], lambda v: CASE WHEN abs(v - trunc(v)) = 0.5e0 "
            f"THEN 2 * round(v / 2) ELSE round(v) END)[1]")


def round_even(x, digits):
    factor = f"{10 ** digits}e0"
    return f"({rint(f'CAST({x} AS DOUBLE) * {factor}')} / {factor})"


def share(part, whole, digits):
    """part / whole * 100 in doubles; NULL for an empty whole."""
    ratio = f"CAST({part} AS DOUBLE) / nullif(CAST({whole} AS DOUBLE), 0)"
    return round_even(f"({ratio} * 100e0)", digits)


def pct(part, whole, scale=100):
    """part * 100 / whole, two digits, half up, in whole numbers."""
    p, w = f"CAST({part} AS HUGEINT)", f"CAST({whole} AS HUGEINT)"
    return f"(CAST((2 * {scale * 100} * {p} + {w}) // (2 * {w}) AS DOUBLE) / 100e0)"


def cents(x):
    return f"CAST(({x}) * 100 AS HUGEINT)"


def mean_money(x):
    """Average of a DECIMAL(15,2), two digits, half up."""
    total, n = f"CAST(SUM({x}) * 100 AS HUGEINT)", f"CAST(COUNT({x}) AS HUGEINT)"
    return f"(CAST((2 * {total} + {n}) // nullif(2 * {n}, 0) AS DOUBLE) / 100e0)"


def money(x):
    return f"CAST({x} AS DOUBLE)"


def quantile(values, p):
    """Linear quantile of a sorted list, from the nearer end."""
    at = f"({p}e0 * CAST(len({values}) - 1 AS DOUBLE))"
    low = f"{values}[CAST(floor({at}) AS BIGINT) + 1]"
    high = f"{values}[CAST(ceil({at}) AS BIGINT) + 1]"
    t = f"({at} - floor({at}))"
    return (f"(CASE WHEN {t} >= 0.5e0 THEN {high} - ({high} - {low}) * (1e0 - {t}) "
            f"ELSE {low} + ({high} - {low}) * {t} END)")


def sorted_list(x):
    return f"list(CAST({x} AS DOUBLE) ORDER BY CAST({x} AS DOUBLE)) FILTER (WHERE {x} IS NOT NULL)"


def strip(s):
    return rf"regexp_replace({s}, '^\s+|\s+$', '', 'g')"


def title(s):
    letter = (f"CASE WHEN i = 1 OR NOT regexp_full_match(substr({s}, i - 1, 1), '[A-Za-z]') "
              f"THEN upper(substr({s}, i, 1)) ELSE lower(substr({s}, i, 1)) END")
    return (f"CASE WHEN {s} IS NOT NULL THEN array_to_string(list_transform("
            f"range(1, len({s}) + 1), lambda i: {letter}), '') END")


def bands(x, edges, labels):
    whens = " ".join(
        f"WHEN {x} > {edges[i]} AND {x} <= {edges[i + 1]} THEN '{label}'"
        for i, label in enumerate(labels)
    )
    return f"(CASE {whens} END)"


# Bands.
CREDIT = ((0, 579, 669, 739, 799, 900), ("Poor", "Fair", "Good", "Very Good", "Excellent"))
CREDIT_RANGED = (CREDIT[0], ("Poor (300-579)", "Fair (580-669)", "Good (670-739)",
                             "Very Good (740-799)", "Excellent (800-850)"))
AGE = ((0, 25, 35, 50, 65, 100), ("Under 25", "25-35", "36-50", "51-65", "65+"))
TENURE = ((0, 2, 5, 8, 10), ("New (0-2 yrs)", "Growing (3-5 yrs)", "Mature (6-8 yrs)",
                             "Loyal (9-10 yrs)"))
RISK = ((-1, 2, 4, 6, 10), ("Low Risk", "Medium Risk", "High Risk", "Critical Risk"))

RAW_COLUMNS = (
    "RowNumber", "CustomerId", "Surname", "CreditScore", "Geography", "Gender", "Age",
    "Tenure", "Balance", "NumOfProducts", "HasCrCard", "IsActiveMember", "EstimatedSalary",
    "Exited", "Complain", "Satisfaction Score", "Card Type", "Point Earned",
)
RAW_TYPES = dict.fromkeys(RAW_COLUMNS, "int") | {
    "RowNumber": "bigint", "CustomerId": "bigint", "Surname": "string", "Geography": "string",
    "Gender": "string", "Balance": "double", "EstimatedSalary": "double", "Card Type": "string",
}
NUMERIC_COLUMNS = tuple(c for c in RAW_COLUMNS if RAW_TYPES[c] != "string")


def quoted(columns):
    return ", ".join(f'"{c}"' for c in columns)


def query(ctes, select):
    """WITH from (name, body) pairs, each name once, then the final SELECT."""
    seen = {}
    for name, body in ctes:
        seen.setdefault(name, body)
    head = ",\n".join(f"{name} AS ({body})" for name, body in seen.items())
    return f"WITH {head}\n{select}"


def raw(name="raw", as_of=None):
    bound = f"WHERE CAST(o_orderdate AS DATE) <= DATE '{as_of}'" if as_of else ""
    o, g, m = f"{name}_orders", f"{name}_per", f"{name}_last"
    return [
        (o, f"SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, o_orderpriority AS p "
            f"FROM orders {bound}"),
        (m, f"SELECT MAX(d) AS mx FROM {o}"),
        (g, f"""SELECT o_custkey, (SELECT mx FROM {m}) - MIN(d) AS oldest,
                (SELECT mx FROM {m}) - MAX(d) AS newest,
                COUNT(*) FILTER (WHERE (SELECT mx FROM {m}) - d <= 730) AS recent,
                COUNT(DISTINCT CASE WHEN (SELECT mx FROM {m}) - d <= 730 THEN p END) AS prio
                FROM {o} GROUP BY o_custkey"""),
        (name, f"""SELECT c_custkey + 1 AS "RowNumber", c_custkey AS "CustomerId",
            c_name AS "Surname",
            CAST(300 + c_custkey * 37 % 551 AS INTEGER) AS "CreditScore",
            r_name AS "Geography",
            CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS "Gender",
            CAST(18 + c_custkey * 31 % 72 AS INTEGER) AS "Age",
            CAST(oldest // 365 AS INTEGER) AS "Tenure",
            CAST(CAST(greatest(c_acctbal, 0e0) * 20 AS DECIMAL(15,2)) AS DOUBLE) AS "Balance",
            CAST(least(4, greatest(1, prio)) AS INTEGER) AS "NumOfProducts",
            CAST(c_custkey % 10 < 7 AS INTEGER) AS "HasCrCard",
            CAST(coalesce(recent, 0) >= 2 AS INTEGER) AS "IsActiveMember",
            CAST(30000 + c_custkey * 7919 % 120000 AS DOUBLE) AS "EstimatedSalary",
            CAST(coalesce(newest > 365, true) AS INTEGER) AS "Exited",
            CAST(c_custkey % 5 = 0 AS INTEGER) AS "Complain",
            CAST(1 + c_custkey % 5 AS INTEGER) AS "Satisfaction Score",
            c_mktsegment AS "Card Type",
            CAST(119 + c_custkey * 13 % 882 AS INTEGER) AS "Point Earned"
            FROM customer LEFT JOIN {g} ON c_custkey = o_custkey
            JOIN nation ON c_nationkey = n_nationkey
            JOIN region ON n_regionkey = r_regionkey"""),
    ]


GAPS = {"Balance": 17, "CreditScore": 19, "EstimatedSalary": 13, "Age": 23, "Tenure": 29,
        "HasCrCard": 31, "IsActiveMember": 37, "Geography": 41, "Gender": 43}


def dirty():
    noisy = {
        "Surname": """CASE WHEN "CustomerId" % 5 = 0 THEN concat(chr(9),
            'o''brien smith-jones ', CAST("CustomerId" % 7 AS VARCHAR), 'x ')
            ELSE "Surname" END""",
        "Geography": """CASE WHEN "CustomerId" % 3 = 0
            THEN concat('  ', lower("Geography"), chr(9)) ELSE "Geography" END""",
        "Gender": """CASE WHEN "CustomerId" % 4 = 1
            THEN concat(chr(9), upper("Gender"), ' ') ELSE "Gender" END""",
    }
    cols = []
    for c in RAW_COLUMNS:
        e = noisy.get(c, f'"{c}"')
        if c in GAPS:
            e = f'CASE WHEN "CustomerId" % {GAPS[c]} <> 0 THEN {e} END'
        cols.append(f'{e} AS "{c}"')
    rekeyed = ", ".join({
        "RowNumber": '"RowNumber" + 1000000000',
        "Balance": 'coalesce("Balance", 0e0) + 1000',
    }.get(c, f'"{c}"') for c in RAW_COLUMNS)
    return raw() + [
        ("gappy", f"SELECT {', '.join(cols)} FROM raw"),
        ("dirty", f"""SELECT * FROM gappy
            UNION ALL SELECT * FROM gappy WHERE "CustomerId" % 50 = 0
            UNION ALL SELECT {rekeyed} FROM gappy WHERE "CustomerId" % 70 = 0
            UNION ALL SELECT * REPLACE (0e0 AS "Balance") FROM gappy WHERE "CustomerId" % 34 = 0"""),
    ]


def snapshot():
    return raw("snap_all", "1999-12-31") + [
        ("snap", 'SELECT * FROM snap_all WHERE "CustomerId" % 97 <> 0'),
    ]


def incoming():
    moved = """CASE WHEN "CustomerId" % 50 = 0 THEN CASE upper("Geography")
        WHEN 'AFRICA' THEN 'America' WHEN 'AMERICA' THEN 'Asia' WHEN 'ASIA' THEN 'Europe'
        WHEN 'EUROPE' THEN 'Middle East' WHEN 'MIDDLE EAST' THEN 'Africa' END
        ELSE "Geography" END"""
    return raw() + [("inc", f'SELECT * REPLACE ({moved} AS "Geography") FROM raw')]


def mode_of(src, c):
    return (f'(SELECT "{c}" FROM {src} WHERE "{c}" IS NOT NULL GROUP BY "{c}" '
            f'ORDER BY COUNT(*) DESC, "{c}" LIMIT 1)')


def impute_columns(src, lists):
    med = {c: f'(SELECT {quantile(f"l_{c}", 0.5)} FROM {lists})'
           for c in ("CreditScore", "EstimatedSalary", "Age", "Tenure")}
    return {
        "Balance": 'coalesce("Balance", 0e0)',
        "CreditScore": f'coalesce(CAST("CreditScore" AS DOUBLE), {med["CreditScore"]})',
        "EstimatedSalary": f'coalesce("EstimatedSalary", {med["EstimatedSalary"]})',
        "Age": f'coalesce("Age", CAST(trunc({med["Age"]}) AS INTEGER))',
        "Tenure": f'coalesce("Tenure", CAST(trunc({med["Tenure"]}) AS INTEGER))',
        **{c: f'coalesce("{c}", {mode_of(src, c)})'
           for c in ("HasCrCard", "IsActiveMember", "Geography", "Gender")},
    }


def imputed(src):
    lists = ", ".join(f'{sorted_list(chr(34) + c + chr(34))} AS l_{c}'
                      for c in ("CreditScore", "EstimatedSalary", "Age", "Tenure"))
    replaced = ", ".join(
        f'{e} AS "{c}"' for c, e in impute_columns(src, f"{src}_lists").items())
    return [
        (f"{src}_lists", f"SELECT {lists} FROM {src}"),
        (f"{src}_imp", f"SELECT * REPLACE ({replaced}) FROM {src}"),
    ]


def dedup(src, name):
    return [(name, f"""SELECT * FROM {src} QUALIFY row_number() OVER (
        PARTITION BY "CustomerId" ORDER BY "RowNumber" DESC) = 1""")]


def standard_columns():
    whole = ("CreditScore", "Age", "Tenure", "NumOfProducts", "HasCrCard", "IsActiveMember",
             "Exited")
    steps = {c: f'CAST(trunc("{c}") AS INTEGER)' for c in whole}
    steps |= {c: round_even(f'"{c}"', 2) for c in ("Balance", "EstimatedSalary")}
    steps |= {c: title(strip(f'"{c}"')) for c in ("Geography", "Gender", "Surname")}
    return ", ".join(f'{e} AS "{c}"' for c, e in steps.items())


CAPPED = ("CreditScore", "Balance", "EstimatedSalary")


def cleansed(src):
    return imputed(src) + dedup(f"{src}_imp", f"{src}_dd") + [
        (f"{src}_std", f"SELECT * REPLACE ({standard_columns()}) FROM {src}_dd"),
    ]


def capped(src):
    lists = ", ".join(f'{sorted_list(chr(34) + c + chr(34))} AS l_{c}' for c in CAPPED)
    caps = ", ".join(
        f'{quantile(f"l_{c}", p)} AS "{c}_{tag}"'
        for c in CAPPED for p, tag in ((0.01, "lo"), (0.99, "hi")))
    clip = {c: f'least(greatest(CAST("{c}" AS DOUBLE), (SELECT "{c}_lo" FROM {src}_caps)), '
               f'(SELECT "{c}_hi" FROM {src}_caps))' for c in CAPPED}
    clip["Age"] = 'least(greatest("Age", 18), 100)'
    clip["Tenure"] = 'least(greatest("Tenure", 0), 10)'
    replaced = ", ".join(
        f'CASE WHEN "{c}" IS NOT NULL THEN {e} END AS "{c}"' for c, e in clip.items())
    return cleansed(src) + [
        (f"{src}_cl", f"SELECT {lists} FROM {src}_std"),
        (f"{src}_caps", f"SELECT {caps} FROM {src}_cl"),
        (f"{src}_cap", f"SELECT * REPLACE ({replaced}) FROM {src}_std"),
    ]


def derived_columns():
    ltv = '("Balance" * 0.02e0 + "EstimatedSalary" * 0.001e0 * "Tenure")'
    return {
        "AgeGroup": bands('"Age"', *AGE),
        "CreditTier": bands('"CreditScore"', *CREDIT),
        "TenureBand": bands('"Tenure"', *TENURE),
        "HighValueFlag": """CASE WHEN "Balance" > 100000 THEN 'Y' ELSE 'N' END""",
        "EstimatedLTV": round_even(ltv, 2),
        "ChurnLabel": """CASE "Exited" WHEN 0 THEN 'Active' WHEN 1 THEN 'Churned' END""",
        "BalanceSalaryRatio": f'CASE WHEN "EstimatedSalary" > 0 THEN '
                              f'{round_even(chr(34) + "Balance" + chr(34) + "/" + chr(34) + "EstimatedSalary" + chr(34), 4)} ELSE 0e0 END',
        "ProductEngagement": 'CAST(least(greatest("NumOfProducts" + "IsActiveMember" * 2 '
                             '+ "HasCrCard", 0), 10) AS INTEGER)',
    }


def derive(src, name):
    cols = ", ".join(f'{e} AS "{c}"' for c, e in derived_columns().items())
    score = """CAST((CASE WHEN "NumOfProducts" >= 3 THEN 3 ELSE 0 END)
        + (CASE WHEN "IsActiveMember" = 0 THEN 3 ELSE 0 END)
        + (CASE WHEN "Age" >= 51 THEN 2 ELSE 0 END) + (CASE WHEN "Tenure" <= 2 THEN 1 ELSE 0 END)
        + (CASE WHEN "HighValueFlag" = 'Y' THEN 1 ELSE 0 END) AS INTEGER)"""
    return [
        (f"{name}_d", f"SELECT *, {cols} FROM {src}"),
        (f"{name}_s", f'SELECT *, {score} AS "RiskScore" FROM {name}_d'),
        (name, f'SELECT *, {bands(chr(34) + "RiskScore" + chr(34), *RISK)} AS "RiskCategory" '
               f"FROM {name}_s"),
    ]


WAREHOUSE_NAMES = {
    "CustomerId": "customer_id", "Surname": "surname", "CreditScore": "credit_score",
    "Geography": "geography", "Gender": "gender", "Age": "age", "Tenure": "tenure",
    "Balance": "balance", "NumOfProducts": "num_of_products", "HasCrCard": "has_cr_card",
    "IsActiveMember": "is_active_member", "EstimatedSalary": "estimated_salary",
    "Exited": "churn_flag", "Complain": "Complain", "Satisfaction Score": "Satisfaction Score",
    "Card Type": "Card Type", "Point Earned": "Point Earned", "AgeGroup": "age_group",
    "CreditTier": "credit_tier", "TenureBand": "tenure_band", "HighValueFlag": "high_value_flag",
    "EstimatedLTV": "estimated_ltv", "ChurnLabel": "churn_label",
    "BalanceSalaryRatio": "balance_salary_ratio", "ProductEngagement": "product_engagement",
    "RiskScore": "risk_score", "RiskCategory": "risk_category",
}
FEED_COLUMNS = tuple(WAREHOUSE_NAMES.values())


def enriched(src):
    """Feed rows in warehouse names, with RowNumber."""
    names = ", ".join(f'"{a}" AS "{b}"' for a, b in WAREHOUSE_NAMES.items())
    return capped(src) + derive(f"{src}_cap", f"{src}_risk") + [
        (f"{src}_rows", f'SELECT "RowNumber", {names} FROM {src}_risk'),
    ]


def staged(src, load_date):
    return enriched(src) + [(f"{src}_staged", f"""SELECT
        row_number() OVER (ORDER BY "RowNumber", customer_id) AS customer_sk,
        {quoted(FEED_COLUMNS)}, DATE '{load_date}' AS effective_start_date,
        DATE '9999-12-31' AS effective_end_date, 1 AS is_current, 1 AS record_version
        FROM {src}_rows""")]


STAGED_COLUMNS = ("customer_sk", *FEED_COLUMNS, "effective_start_date", "effective_end_date",
                  "is_current", "record_version")
TRACKED = ("geography", "num_of_products", "is_active_member", "has_cr_card")


def stg_dirty():
    return dirty() + staged("dirty", "2001-08-02")


def history_inputs():
    return snapshot() + staged("snap", "2000-01-01") + incoming() + enriched("inc")


def classified():
    differs = " OR ".join(f"i.{c} IS DISTINCT FROM d.{c}" for c in TRACKED)
    old = ", ".join(f"d.{c} AS old_{c}" for c in TRACKED)
    return history_inputs() + [("cls", f"""SELECT i.*, d.customer_sk AS old_sk,
        d.record_version AS old_version, {old},
        CASE WHEN d.customer_id IS NULL THEN 'new' WHEN {differs} THEN 'changed'
        ELSE 'unchanged' END AS status
        FROM inc_rows i LEFT JOIN snap_staged d
        ON i.customer_id = d.customer_id AND d.is_current = 1""")]


def merged():
    feed = quoted(FEED_COLUMNS)
    return classified() + [
        ("ins", f"""SELECT (SELECT MAX(customer_sk) FROM snap_staged) + row_number() OVER (
            ORDER BY CAST(status = 'new' AS INTEGER), customer_id) AS customer_sk, {feed},
            DATE '2001-08-02' AS effective_start_date, DATE '9999-12-31' AS effective_end_date,
            1 AS is_current, coalesce(old_version, 0) + 1 AS record_version
            FROM cls WHERE status <> 'unchanged'"""),
        ("kept", f"""SELECT customer_sk, {feed}, effective_start_date,
            CASE WHEN customer_sk IN (SELECT old_sk FROM cls WHERE status = 'changed')
                THEN DATE '2001-08-01' ELSE effective_end_date END AS effective_end_date,
            CASE WHEN customer_sk IN (SELECT old_sk FROM cls WHERE status = 'changed')
                THEN 0 ELSE is_current END AS is_current, record_version FROM snap_staged"""),
        ("merged", "SELECT * FROM kept UNION ALL SELECT * FROM ins"),
    ]


DECIMALS = {"balance": "DECIMAL(15,2)", "estimated_salary": "DECIMAL(15,2)",
            "estimated_ltv": "DECIMAL(15,2)", "balance_salary_ratio": "DECIMAL(10,4)"}


def typed(src):
    casts = {c: f"CAST({c} AS {t})" for c, t in DECIMALS.items()}
    casts["credit_score"] = "CAST(round(credit_score) AS INTEGER)"
    return "SELECT * REPLACE (" + ", ".join(
        f"{e} AS {c}" for c, e in casts.items()) + f") FROM {src}"


def as_doubles(src, columns=DECIMALS):
    return "SELECT * REPLACE (" + ", ".join(
        f"CAST({c} AS DOUBLE) AS {c}" for c in columns) + f") FROM {src}"


def dim_customer():
    return merged() + [("dimc", typed("merged")),
                       ("cur", "SELECT * FROM dimc WHERE is_current = 1")]


def products():
    return [
        ("prod_n", "SELECT p_type, row_number() OVER (ORDER BY p_type) AS n "
                   "FROM (SELECT DISTINCT p_type FROM part)"),
        ("prod", """SELECT n AS product_sk, n AS product_id, p_type AS product_name,
            CASE n % 3 WHEN 1 THEN 'Deposit' WHEN 2 THEN 'Loan' ELSE 'Credit' END
            AS product_category, CAST(n * 1.25 AS DECIMAL(5,2)) AS interest_rate_pct,
            1 AS is_active, 2015 AS launch_year FROM prod_n"""),
    ]


LINE_KEY = ("l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, "
            "l_extendedprice")


def transactions():
    return raw() + products() + [("txn", f"""SELECT
        row_number() OVER (ORDER BY {LINE_KEY}) AS transaction_id, o_custkey AS customer_id,
        CAST(l_shipdate AS DATE) AS transaction_date,
        CAST(year(l_shipdate) AS INTEGER) AS transaction_year,
        CAST(month(l_shipdate) AS INTEGER) AS transaction_month,
        l_returnflag AS transaction_type, o_orderpriority AS channel, product_id,
        CAST(round(CAST(l_extendedprice AS DECIMAL(15,2))
            * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) AS DECIMAL(15,2)) AS amount,
        "Exited" AS churn_flag
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN part ON l_partkey = p_partkey JOIN prod ON p_type = product_name
        LEFT JOIN raw ON o_custkey = "CustomerId" """)]


def fact():
    return dim_customer() + transactions() + [
        ("look", "SELECT customer_id, MAX(customer_sk) AS customer_sk FROM cur GROUP BY 1"),
        ("fact", """SELECT transaction_id AS transaction_sk, transaction_id, customer_sk,
            product_sk, CAST(strftime(transaction_date, '%Y%m%d') AS INTEGER) AS date_sk,
            t.customer_id, transaction_date, transaction_year, transaction_month,
            transaction_type, channel, amount, coalesce(churn_flag, 0) AS churn_flag
            FROM txn t LEFT JOIN look ON t.customer_id = look.customer_id
            LEFT JOIN prod ON t.product_id = prod.product_id"""),
    ]


def dim_date():
    quarter = "CAST(quarter(d) AS INTEGER)"
    return [
        ("span", "SELECT MIN(CAST(l_shipdate AS DATE)) AS a, MAX(CAST(l_shipdate AS DATE)) AS b "
                 "FROM lineitem"),
        ("days", "SELECT CAST(unnest(generate_series((SELECT a FROM span), (SELECT b FROM span), "
                 "INTERVAL 1 DAY)) AS DATE) AS d"),
        ("dimd", f"""SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_sk, d AS full_date,
            CAST(year(d) AS INTEGER) AS year, {quarter} AS quarter,
            CAST(month(d) AS INTEGER) AS month, strftime(d, '%B') AS month_name,
            strftime(d, '%b') AS month_short, CAST(weekofyear(d) AS INTEGER) AS week_no,
            CAST(day(d) AS INTEGER) AS day_of_month,
            CAST(isodow(d) AS INTEGER) AS day_of_week_no, strftime(d, '%A') AS day_name,
            CAST(isodow(d) >= 6 AS INTEGER) AS is_weekend,
            CAST(day(d) = 1 AS INTEGER) AS is_month_start,
            CAST(d = last_day(d) AS INTEGER) AS is_month_end,
            strftime(d, '%Y-%m') AS year_month,
            concat(year(d), '-Q', quarter(d)) AS year_quarter FROM days"""),
    ]


def churn_reasons():
    return raw() + [("dimr", f"""SELECT row_number() OVER (
            ORDER BY "Exited" DESC, "CustomerId") AS churn_reason_sk,
            "CustomerId" AS customer_id, "Exited" AS churn_flag,
            CASE WHEN "Exited" = 1 THEN concat('Reason ', CAST("CustomerId" % 7 + 1 AS VARCHAR))
            ELSE 'N/A - Active Customer' END AS churn_reason,
            CASE WHEN "Exited" = 1 THEN (SELECT strftime(MAX(CAST(o_orderdate AS DATE)), '%Y-%m')
            FROM orders WHERE o_custkey = "CustomerId") END AS exit_month FROM raw""")]
