"""One check query per registered query, keyed alike."""

from oracle import parts as p
from oracle.parts import money, pct, query, quoted, round_even, share


def _union(rows):
    return "\nUNION ALL ".join(rows)


def _names(columns):
    return quoted(columns)


def _counted_nulls(c):
    return f'COUNT(*) FILTER (WHERE "{c}" IS NULL)'


def _churn_table(src, key, name, flag='"Exited"', extra=""):
    return (f"SELECT {key} AS {name}, COUNT({flag}) AS total, CAST(SUM({flag}) AS BIGINT) AS churned, "
            f"{share(f'SUM({flag})', f'COUNT({flag})', 1)} AS churn_rate_pct{extra} "
            f"FROM {src} WHERE {key} IS NOT NULL GROUP BY {key}")


def _staged_out(src):
    return f"SELECT {_names(p.STAGED_COLUMNS)} FROM {src}"


def _dup_profile():
    return [("dups", f"""SELECT COUNT(*) AS total_rows,
        COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM dirty)) AS duplicate_rows,
        COUNT(*) - COUNT(DISTINCT "CustomerId") AS duplicate_keys FROM dirty""")]


def _column_inventory():
    kinds = p.RAW_TYPES
    rows = [
        f"SELECT {i} AS position, '{c}' AS \"column\", '{kinds[c]}' AS dtype, "
        f'coalesce(CAST(MIN("{c}") AS VARCHAR), \'N/A\') AS sample_value FROM dirty'
        for i, c in enumerate(p.RAW_COLUMNS, 1)
    ]
    return query(p.dirty(), _union(rows))


def _schema_diff():
    expected = p.RAW_COLUMNS[:14]
    rows = [
        f"SELECT '{c}' AS \"column\", '{'ok' if c in expected else 'unexpected'}' AS status, "
        f'COUNT("{c}") AS non_null FROM dirty' for c in p.RAW_COLUMNS
    ]
    return query(p.dirty(), _union(rows))


def _null_profile():
    rows = [
        f"SELECT '{c}' AS \"column\", {_counted_nulls(c)} AS null_count, "
        f"{share(_counted_nulls(c), 'COUNT(*)', 2)} AS null_pct, CASE WHEN {_counted_nulls(c)} = 0 "
        f"THEN 'OK' ELSE 'NEEDS TREATMENT' END AS status FROM dirty" for c in p.RAW_COLUMNS
    ]
    return query(p.dirty(), _union(rows))


def _describe():
    lists = ", ".join(f'{p.sorted_list(chr(34) + c + chr(34))} AS "{c}"' for c in p.NUMERIC_COLUMNS)
    rows = []
    for c in p.NUMERIC_COLUMNS:
        q = f'"{c}"'
        rows.append(
            f"SELECT '{c}' AS \"column\", COUNT({q}) AS count, {round_even(f'AVG({q})', 2)} AS mean, "
            f"{round_even(f'stddev_samp({q})', 2)} AS std, {round_even(f'MIN({q})', 2)} AS min, "
            + ", ".join(
                f"(SELECT {round_even(p.quantile(q, x), 2)} FROM lists) AS {n}"
                for x, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")))
            + f", {round_even(f'MAX({q})', 2)} AS max FROM dirty")
    return query(p.dirty() + [("lists", f"SELECT {lists} FROM dirty")], _union(rows))


def _outliers():
    columns = ("CreditScore", "Age", "Balance", "EstimatedSalary")
    lists = ", ".join(f'{p.sorted_list(chr(34) + c + chr(34))} AS "{c}"' for c in columns)
    rows = []
    for c in columns:
        q = f'"{c}"'
        q1, q3 = p.quantile(q, 0.25), p.quantile(q, 0.75)
        low = f"(SELECT {q1} - 1.5e0 * ({q3} - {q1}) FROM lists)"
        high = f"(SELECT {q3} + 1.5e0 * ({q3} - {q1}) FROM lists)"
        out = f"COUNT(*) FILTER (WHERE {q} < {low} OR {q} > {high})"
        rows.append(
            f"SELECT '{c}' AS \"column\", {low} AS lower_fence, {high} AS upper_fence, "
            f"{out} AS outliers, {share(out, 'COUNT(*)', 1)} AS outlier_pct, "
            f"CAST(MIN({q}) AS DOUBLE) AS min_value, CAST(MAX({q}) AS DOUBLE) AS max_value FROM dirty")
    return query(p.dirty() + [("lists", f"SELECT {lists} FROM dirty")], _union(rows))


def _value_counts():
    columns = ("Geography", "Gender", "HasCrCard", "IsActiveMember", "NumOfProducts")
    rows = [
        f"SELECT '{c}' AS \"column\", CAST(\"{c}\" AS VARCHAR) AS value, COUNT(*) AS n, "
        f"{share('COUNT(*)', '(SELECT COUNT(*) FROM dirty)', 1)} AS pct FROM dirty "
        f'WHERE "{c}" IS NOT NULL GROUP BY "{c}"' for c in columns
    ]
    return query(p.dirty(), _union(rows))


def _metric(section, name, value, src):
    return (f"SELECT '{section}' AS section, '{name}' AS metric, CAST({value} AS DOUBLE) AS value "
            f"FROM {src}")


def _report_validation():
    with_nulls = " + ".join(
        f"CASE WHEN {_counted_nulls(c)} > 0 THEN 1 ELSE 0 END" for c in p.RAW_COLUMNS)
    rows = [
        _metric("dataset", "total_rows", "COUNT(*)", "dirty"),
        _metric("dataset", "total_columns", "18", "dups"),
        _metric("dataset", "columns_with_nulls", with_nulls, "dirty"),
        _metric("dataset", "churn_rate_pct", share('SUM("Exited")', "COUNT(*)", 1), "dirty"),
        _metric("duplicates", "duplicate_rows", "duplicate_rows", "dups"),
        _metric("duplicates", "duplicate_customer_ids", "duplicate_keys", "dups"),
    ] + [_metric("nulls", c, _counted_nulls(c), "dirty") for c in p.RAW_COLUMNS]
    return query(p.dirty() + _dup_profile(), _union(rows))


def _gate_parts():
    mandatory = ("customer_sk", "customer_id", "credit_score", "geography", "gender", "age",
                 "tenure", "churn_flag", "is_current")
    n = "(SELECT COUNT(*) FROM dirty_staged)"
    deciding = [("row_retention",
                 "greatest(0, CAST(ceil((SELECT COUNT(*) FROM dirty) * 99 / 100e0) AS BIGINT) "
                 f"- {n})")]
    deciding += [(f"mandatory_{c}", f"(SELECT {_counted_nulls(c)} FROM dirty_staged)")
                 for c in mandatory]
    deciding += [("surrogate_key_unique",
                  "(SELECT COUNT(*) - COUNT(DISTINCT customer_sk) FROM dirty_staged)")]
    info = [
        ("all_current", "(SELECT COUNT(*) FILTER (WHERE is_current IS DISTINCT FROM 1) "
                        "FROM dirty_staged)"),
        ("churn_flag_binary", "(SELECT COUNT(*) FILTER (WHERE NOT coalesce(churn_flag IN (0, 1), "
                              "false)) FROM dirty_staged)"),
        ("one_current_row_per_customer", "(SELECT COUNT(*) - COUNT(DISTINCT customer_id) "
                                         "FROM dirty_staged WHERE is_current = 1)"),
    ]
    rows = [f"SELECT '{c}' AS \"check\", CAST({v} AS BIGINT) AS violations, {d} AS decides_gate"
            for d, group in ((1, deciding), (0, info)) for c, v in group]
    return [("checks", _union(rows))]


def _quality_gate():
    return query(p.stg_dirty() + _gate_parts(), """SELECT "check", violations,
        CASE WHEN violations = 0 THEN 'OK' ELSE 'FAIL' END AS status, decides_gate,
        CASE WHEN (SELECT SUM(violations) FROM checks WHERE decides_gate = 1) = 0
        THEN 'PASSED' ELSE 'FAILED' END AS gate FROM checks""")


def _report_etl():
    s = "dirty_staged"
    source = "(SELECT COUNT(*) FROM dirty)"
    rows = [
        _metric("volume", "source_rows", source, "(SELECT 1)"),
        _metric("volume", "staging_rows", "COUNT(*)", s),
        _metric("volume", "retention_pct", share("COUNT(*)", source, 1), s),
        _metric("volume", "staging_columns", str(len(p.STAGED_COLUMNS)), "(SELECT 1)"),
        _metric("gate", "passed", "CASE WHEN SUM(violations) = 0 THEN 1 ELSE 0 END",
                "checks WHERE decides_gate = 1"),
        _metric("churn", "churned", "SUM(churn_flag)", s),
        _metric("churn", "active", "COUNT(*) FILTER (WHERE churn_flag = 0)", s),
        _metric("churn", "churned_pct", share("SUM(churn_flag)", "COUNT(*)", 1), s),
    ] + [_metric("risk", c, f"COUNT(*) FILTER (WHERE risk_category = '{c}')", s)
         for c in p.RISK[1]]
    return query(p.stg_dirty() + _gate_parts(), _union(rows))


def _cap_counts():
    rows = []
    for c in p.CAPPED:
        low, high = (f'(SELECT "{c}_{t}" FROM dirty_caps)' for t in ("lo", "hi"))
        rows.append(
            f"SELECT '{c}' AS \"column\", {low} AS lower_cap, {high} AS upper_cap, COUNT(*) FILTER "
            f'(WHERE "{c}" < {low} OR "{c}" > {high}) AS values_capped FROM dirty_std')
    for c, low, high in (("Age", 18, 100), ("Tenure", 0, 10)):
        rows.append(
            f"SELECT '{c}' AS \"column\", {low}e0 AS lower_cap, {high}e0 AS upper_cap, COUNT(*) "
            f'FILTER (WHERE "{c}" < {low} OR "{c}" > {high}) AS values_capped FROM dirty_std')
    return query(p.dirty() + p.capped("dirty"), _union(rows))


def _step_counts():
    tables = {"raw": "dirty", "Null Treatment": "dirty_imp",
              "Full Row Deduplication": "(SELECT DISTINCT * FROM dirty_imp)",
              "Key Deduplication": "dirty_dd", "Standardization": "dirty_std",
              "Outlier Capping": "dirty_cap"}
    names = list(tables)
    count = lambda name: f"(SELECT COUNT(*) FROM {tables[name]})"
    rows = [
        f"SELECT {i} AS step_no, '{n}' AS step, {count(names[i - 1])} AS rows_before, "
        f"{count(n)} AS rows_after, {count(names[i - 1])} - {count(n)} AS rows_removed"
        for i, n in enumerate(names[1:], 1)
    ]
    return query(p.dirty() + p.capped("dirty"), _union(rows))


def _change_log():
    rows = [
        f"SELECT customer_id, '{c}' AS column_changed, CAST(old_{c} AS VARCHAR) AS old_value, "
        f"CAST({c} AS VARCHAR) AS new_value, DATE '2001-08-02' AS load_date FROM cls "
        f"WHERE status = 'changed' AND {c} IS DISTINCT FROM old_{c}" for c in p.TRACKED
    ]
    return query(p.classified(), _union(rows))


def _table_inventory():
    tables = [("dim_customer", "dimc"), ("dim_product", "prod"), ("dim_date", "dimd"),
              ("dim_churn_reason", "dimr"), ("fact_transactions", "fact"),
              ("stg_customers", "dirty_staged")]
    rows = [f"SELECT '{n}' AS table_name, COUNT(*) AS row_count, 'OK' AS status FROM {t}"
            for n, t in tables]
    rows.append("SELECT 'stg_archive' AS table_name, CAST(0 AS BIGINT) AS row_count, "
                "'MISSING' AS status")
    return query(p.fact() + p.dim_date() + p.churn_reasons() + p.stg_dirty(), _union(rows))


def _orphans():
    dims = {"customer_sk": "dimc", "product_sk": "prod", "date_sk": "dimd"}
    dangling = """SELECT
        CASE WHEN transaction_id % 89 <> 0 THEN customer_sk END AS customer_sk,
        CASE WHEN transaction_id % 97 = 0 THEN product_sk + 1000000 ELSE product_sk END AS product_sk,
        CASE WHEN transaction_id % 83 = 0 THEN 19000101 ELSE date_sk END AS date_sk FROM fact"""
    rows = [
        f"SELECT '{k}' AS foreign_key, COUNT(*) AS orphans FROM late f LEFT JOIN "
        f"(SELECT DISTINCT {k} FROM {d}) d ON f.{k} = d.{k} WHERE d.{k} IS NULL"
        for k, d in dims.items()
    ]
    return query(p.fact() + p.dim_date() + [("late", dangling)], _union(rows))


def _banded_churn(column, bands):
    rows = [f"SELECT {i} AS ordinal, '{b}' AS label" for i, b in enumerate(bands[1], 1)]
    return query(p.raw() + [
        ("bins", _union(rows)),
        ("found", f'SELECT {p.bands(column, *bands)} AS label, "Exited" AS e FROM raw'),
    ], f"""SELECT ordinal, b.label, COUNT(e) AS total, CAST(coalesce(SUM(e), 0) AS BIGINT) AS churned,
        {share('SUM(e)', 'COUNT(e)', 1)} AS churn_rate_pct
        FROM bins b LEFT JOIN found f ON b.label = f.label GROUP BY ordinal, b.label""")


def _banded_counts(column, bands):
    rows = [f"SELECT {i} AS ordinal, '{b}' AS label" for i, b in enumerate(bands[1], 1)]
    return query(p.raw() + [
        ("bins", _union(rows)),
        ("found", f"SELECT {p.bands(column, *bands)} AS flabel FROM raw"),
    ], f"""SELECT ordinal, label, COUNT(flabel) AS customers,
        {share('COUNT(flabel)', '(SELECT COUNT(*) FROM raw)', 1)} AS pct
        FROM bins LEFT JOIN found ON label = flabel GROUP BY ordinal, label""")


def _histogram(column, bins, where="true", by=None):
    key = f'"{by}", ' if by else ""
    using = f'USING ("{by}")' if by else "ON true"
    using_bin = f'USING ("{by}", bin)' if by else "USING (bin)"
    group = f'GROUP BY "{by}"' if by else ""
    edge = lambda i: round_even(
        f"(lo + (hi - lo) * {i} / {bins}e0)", 4)
    return query(p.raw() + [
        ("vals", f'SELECT {key} CAST("{column}" AS DOUBLE) AS v FROM raw '
                 f'WHERE {where} AND "{column}" IS NOT NULL'),
        ("rng", f"SELECT {key} MIN(v) AS lo, MAX(v) AS hi FROM vals {group}"),
        ("hit", f"SELECT {key} CAST(least(floor((v - lo) * {bins}e0 / (hi - lo)), {bins - 1}) AS INTEGER) + 1 AS bin, "
                f"COUNT(*) AS n FROM vals JOIN rng {using} GROUP BY ALL"),
        ("slots", f"SELECT {key} lo, hi, unnest(range(1, {bins + 1})) AS bin FROM rng"),
    ], f"""SELECT {key} CAST(bin AS INTEGER) AS bin, {edge('(bin - 1)')} AS lower, {edge('bin')} AS upper,
        CAST(coalesce(n, 0) AS BIGINT) AS customers FROM slots LEFT JOIN hit {using_bin}""")


def _box():
    q = {n: p.quantile("l", x) for n, x in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))}
    return query(p.raw() + [
        ("lists", f'SELECT "Exited", {p.sorted_list(chr(34) + "CreditScore" + chr(34))} AS l '
                  f'FROM raw GROUP BY "Exited"'),
        ("qs", f'SELECT "Exited", {q["q1"]} AS q1, {q["median"]} AS median, {q["q3"]} AS q3 FROM lists'),
        ("f", """SELECT "Exited", q1, median, q3, CAST("CreditScore" AS DOUBLE) AS v,
            CAST("CreditScore" AS DOUBLE) BETWEEN q1 - (q3 - q1) * 1.5e0
            AND q3 + (q3 - q1) * 1.5e0 AS inside FROM raw JOIN qs USING ("Exited")"""),
    ], """SELECT "Exited", MAX(q1) AS q1, MAX(median) AS median, MAX(q3) AS q3,
        MIN(v) FILTER (WHERE inside) AS whisker_low, MAX(v) FILTER (WHERE inside) AS whisker_high,
        COUNT(*) FILTER (WHERE NOT inside) AS outliers FROM f GROUP BY "Exited" """)


CORRELATED = ("CreditScore", "Age", "Tenure", "Balance", "NumOfProducts", "HasCrCard",
              "IsActiveMember", "EstimatedSalary", "Exited")


def _corr(a, b, digits=2):
    return round_even(f'corr(CAST("{a}" AS DOUBLE), CAST("{b}" AS DOUBLE))', digits)


def _corr_matrix():
    rows = [f"SELECT '{a}' AS x, '{b}' AS y, {_corr(a, b)} AS corr FROM dirty"
            for a in CORRELATED for b in CORRELATED]
    return query(p.dirty(), _union(rows))


def _corr_with_churn():
    rows = [f"SELECT '{c}' AS \"column\", {_corr(c, 'Exited')} AS corr FROM dirty"
            for c in CORRELATED if c != "Exited"]
    return query(p.dirty() + [("c", _union(rows))], """SELECT "column", corr,
        concat(CASE WHEN abs(corr) > 0.2e0 THEN 'strong' WHEN abs(corr) > 0.1e0 THEN 'moderate'
        ELSE 'weak' END, CASE WHEN corr > 0 THEN ' positive' ELSE ' negative' END) AS label FROM c""")


def _univariate():
    columns = ("CreditScore", "Age", "Balance")
    lists = ", ".join(f'{p.sorted_list(chr(34) + c + chr(34))} AS "{c}"' for c in columns)
    rows = [
        f"SELECT '{c}' AS \"column\", CAST(MIN(\"{c}\") AS DOUBLE) AS min, "
        f'CAST(MAX("{c}") AS DOUBLE) AS max, {round_even(f"""AVG("{c}")""", 1)} AS mean, '
        f'(SELECT {round_even(p.quantile(chr(34) + c + chr(34), 0.5), 1)} FROM lists) AS median, '
        f'{round_even(f"""stddev_samp("{c}")""", 1)} AS std, '
        f'{round_even(f"""skewness("{c}")""", 3)} AS skew FROM raw' for c in columns
    ]
    return query(p.raw() + [("lists", f"SELECT {lists} FROM raw")], _union(rows))


def _balance_segments():
    values = f"""(SELECT {p.sorted_list('"Balance"')} AS l FROM raw WHERE "Balance" > 0)"""
    high = '(WHERE "Balance" > 100000)'
    return query(p.raw(), f"""SELECT COUNT(*) AS customers,
        COUNT(*) FILTER (WHERE "Balance" = 0) AS zero_balance,
        {share('COUNT(*) FILTER (WHERE "Balance" = 0)', 'COUNT(*)', 1)} AS zero_balance_pct,
        {round_even('AVG("Balance") FILTER (WHERE "Balance" > 0)', 0)} AS nonzero_mean,
        COUNT(*) FILTER {high} AS high_value,
        {share(f'SUM("Exited") FILTER {high}', f'COUNT("Exited") FILTER {high}', 1)}
        AS high_value_churn_rate_pct,
        (SELECT {round_even(p.quantile('l', 0.5), 0)} FROM {values}) AS nonzero_median FROM raw""")


def _pivot(row, name, column, values):
    cells = ", ".join(
        f"""{share(f'SUM("Exited") FILTER (WHERE c = {v})', f'COUNT("Exited") FILTER (WHERE c = {v})', 1)} AS "{n}" """
        for v, n in values.items())
    return query(p.raw() + [("cells", f'SELECT {row} AS r, {column} AS c, "Exited" FROM raw')],
                 f"SELECT r AS {name}, {cells} FROM cells WHERE r IS NOT NULL AND c IS NOT NULL GROUP BY r")


def _mart(select):
    return query(p.dim_customer(), select)


def _q3():
    return query(p.dim_customer() + [("tiles", """SELECT *, ntile(4) OVER (
            ORDER BY estimated_ltv DESC, customer_id) AS t FROM cur""")],
        f"""SELECT CAST(t AS INTEGER) AS ltv_quartile, CASE t WHEN 1 THEN 'Platinum (Top 25%)'
        WHEN 2 THEN 'Gold (26-50%)' WHEN 3 THEN 'Silver (51-75%)' ELSE 'Bronze (Bottom 25%)' END
        AS segment_label, COUNT(*) AS customer_count, {money('MIN(estimated_ltv)')} AS min_ltv,
        {money('MAX(estimated_ltv)')} AS max_ltv, {p.mean_money('estimated_ltv')} AS avg_ltv,
        CAST(SUM(churn_flag) AS BIGINT) AS churned_in_segment,
        {pct('SUM(churn_flag)', 'COUNT(*)')} AS segment_churn_rate_pct FROM tiles GROUP BY t""")


def _q4():
    rate = "(2 * 10000 * CAST(SUM(churn_flag) AS HUGEINT) + COUNT(*)) // (2 * COUNT(*))"
    return query(p.fact() + p.dim_date() + [
        ("m", f"""SELECT year, month, month_name, year_month,
            COUNT(DISTINCT customer_sk) AS total_transactions,
            CAST(SUM(churn_flag) AS BIGINT) AS churned_txns, CAST({rate} AS BIGINT) AS r
            FROM fact JOIN dimd USING (date_sk) GROUP BY ALL"""),
        ("l", "SELECT *, LAG(r) OVER (ORDER BY year, month) AS b FROM m"),
    ], """SELECT year, month, month_name, year_month, total_transactions, churned_txns,
        r / 100e0 AS churn_rate, b / 100e0 AS prev_month_churn_rate,
        (r - b) / 100e0 AS mom_churn_change, CASE WHEN r > b THEN 'Increasing'
        WHEN r < b THEN 'Decreasing' ELSE 'Stable' END AS trend_direction FROM l""")


def _q5():
    return query(p.fact(), f"""SELECT product_name, product_category,
        CAST(interest_rate_pct AS DOUBLE) AS interest_rate_pct,
        COUNT(DISTINCT customer_sk) AS customer_count, COUNT(transaction_sk) AS transaction_count,
        {money('SUM(amount)')} AS total_revenue, {p.mean_money('amount')} AS avg_transaction_value,
        CAST(SUM(churn_flag) AS BIGINT) AS churned_transactions,
        {pct('SUM(churn_flag)', 'COUNT(*)')} AS product_churn_rate_pct,
        CAST(dense_rank() OVER (ORDER BY SUM(amount) DESC) AS INTEGER) AS revenue_rank
        FROM fact JOIN prod USING (product_sk)
        GROUP BY product_name, product_category, interest_rate_pct""")


RATE = pct("SUM(churn_flag)", "COUNT(*)")
CHURNED = "CAST(SUM(churn_flag) AS BIGINT)"


def oracle_sql() -> dict:
    stg, dirty = p.stg_dirty(), p.dirty()
    raw_feed = query(dirty, f"SELECT {_names(p.RAW_COLUMNS)} FROM dirty")
    staged = query(stg, _staged_out("dirty_staged"))
    merged = query(p.merged(), _staged_out("merged"))
    no_row = [c for c in p.RAW_COLUMNS if c != "RowNumber"]
    typed_dim = "SELECT * REPLACE (" + ", ".join(
        f"CAST({c} AS DOUBLE) AS {c}" for c in p.DECIMALS) + ")"
    derived = [c for c in p.derived_columns()]
    found = {
        "scan_raw_customers": raw_feed,
        "scan_staged_customers": staged,
        "sink_roundtrip": staged,
        "sink_append_twice": query(p.transactions(), """SELECT transaction_id, customer_id,
            CAST(2 AS BIGINT) AS copies, CAST(amount * 2 AS DOUBLE) AS amount FROM txn"""),
        "enforce_dim_customer_schema": query(
            stg + [("t", p.typed("dirty_staged"))],
            f"{typed_dim} FROM t"),
        "table_inventory": _table_inventory(),
        "column_inventory": _column_inventory(),
        "schema_diff": _schema_diff(),
        "null_profile": _null_profile(),
        "dup_profile": query(dirty + _dup_profile(), "SELECT * FROM dups"),
        "dup_rows": query(dirty, f"""SELECT {_names(p.RAW_COLUMNS)} FROM dirty QUALIFY COUNT(*) OVER (
            PARTITION BY {_names(p.RAW_COLUMNS)}) > 1"""),
        "dup_keys": query(dirty, """SELECT "CustomerId", "RowNumber", "Surname" FROM dirty
            QUALIFY COUNT(*) OVER (PARTITION BY "CustomerId") > 1"""),
        "churn_distribution": query(dirty, f"""SELECT COUNT(*) AS total,
            CAST(SUM("Exited") AS BIGINT) AS churned,
            CAST(COUNT(*) - SUM("Exited") AS BIGINT) AS active,
            {share('COUNT(*) - SUM("Exited")', 'COUNT(*)', 1)} AS active_pct,
            {share('SUM("Exited")', 'COUNT(*)', 1)} AS churned_pct,
            {round_even('(CAST(SUM("Exited") AS DOUBLE) / (COUNT(*) - SUM("Exited")))', 2)}
            AS churn_to_active_ratio,
            CAST(CAST(SUM("Exited") AS DOUBLE) / (COUNT(*) - SUM("Exited")) < 0.25e0 AS INTEGER)
            AS imbalanced FROM dirty"""),
        "churn_by_geography": query(p.raw(), _churn_table(
            "raw", '"Geography"', "geography",
            extra=", " + share("COUNT(*)", "(SELECT COUNT(*) FROM raw)", 1) + " AS pct_of_customers")),
        "churn_by_gender": query(dirty, _churn_table("dirty", '"Gender"', "gender")),
        "describe_numeric": _describe(),
        "outliers_iqr": _outliers(),
        "value_counts": _value_counts(),
        "report_validation": _report_validation(),
        "etl_impute": query(dirty + p.imputed("dirty"), f"SELECT {_names(p.RAW_COLUMNS)} FROM dirty_imp"),
        "etl_dedup": query(dirty + p.imputed("dirty") + p.dedup("dirty_imp", "dd"),
                           f"SELECT {_names(no_row)} FROM dd"),
        "etl_standardize": query(dirty, f"SELECT * REPLACE ({p.standard_columns()}) FROM dirty"),
        "sample_customers": query(p.raw(), """SELECT "CustomerId", "Age", "Balance", "Exited",
            CAST("Balance" > 100000 AS INTEGER) AS high_value FROM raw
            ORDER BY md5('42:' || CAST("CustomerId" AS VARCHAR)), "CustomerId" LIMIT 500"""),
        "etl_cap": query(dirty + p.capped("dirty"), f"SELECT {_names(no_row)} FROM dirty_cap"),
        "etl_cap_counts": _cap_counts(),
        "etl_step_counts": _step_counts(),
        "derive_columns": query(p.raw() + p.derive("raw", "r"),
                                f'SELECT {_names(["CustomerId", *derived])} FROM r'),
        "risk_score": query(p.raw() + p.derive("raw", "r"),
                            'SELECT "CustomerId", "RiskScore", "RiskCategory" FROM r'),
        "churn_by_risk": query(stg, _churn_table(
            "dirty_staged", "risk_category", "risk_category", "churn_flag")),
        "risk_churn_corr": query(stg, "SELECT 'risk_score' AS x, 'churn_flag' AS y, "
                                 f"{_corr('risk_score', 'churn_flag', 3)} AS corr FROM dirty_staged"),
        "stg_customers": staged,
        "quality_gate": _quality_gate(),
        "report_etl_quality": _report_etl(),
        "preview_staged": query(stg, """SELECT customer_sk, customer_id, geography, age_group,
            credit_tier, churn_flag, risk_category, is_current FROM dirty_staged
            ORDER BY customer_sk LIMIT 5"""),
        "scd2_current": query(p.merged(), _staged_out("merged") + " WHERE is_current = 1"),
        "scd2_classify": query(p.classified(),
                               "SELECT customer_id, status, old_sk, old_version FROM cls"),
        "scd2_change_log": _change_log(),
        "scd2_merge": merged,
        "scd2_verify": query(p.merged(), """SELECT COUNT(*) AS total_rows,
            COUNT(*) FILTER (WHERE is_current = 1) AS current_rows,
            COUNT(*) FILTER (WHERE is_current = 0) AS historical_rows,
            COUNT(DISTINCT CASE WHEN is_current = 0 THEN customer_id END)
            AS multi_version_customers FROM merged"""),
        "scd2_history": query(p.merged(), """SELECT customer_id, geography, num_of_products,
            is_active_member, effective_start_date, effective_end_date, is_current, record_version
            FROM merged WHERE customer_id IN (
                SELECT customer_id FROM merged WHERE is_current = 0)"""),
        "scd2_stream": f"SELECT * EXCLUDE (customer_sk) FROM ({merged})",
        "scd2_asof_fact": query(p.fact(), """SELECT f.transaction_id, f.customer_id,
            f.transaction_date, CAST(f.amount AS DOUBLE) AS amount, d.customer_sk AS version_sk,
            d.record_version, d.geography FROM fact f LEFT JOIN dimc d
            ON f.customer_id = d.customer_id
            AND f.transaction_date BETWEEN d.effective_start_date AND d.effective_end_date"""),
        "dim_customer": query(p.dim_customer(), f"{typed_dim} FROM dimc"),
        "dim_product": query(p.products(), p.as_doubles("prod", ["interest_rate_pct"])),
        "dim_date": query(p.dim_date(), "SELECT * FROM dimd"),
        "dim_churn_reason": query(p.churn_reasons(), "SELECT * FROM dimr"),
        "fact_transactions": query(p.fact(), p.as_doubles("fact", ["amount"])),
        "fact_key_resolution": query(p.fact(), """SELECT COUNT(*) AS fact_rows,
            COUNT(customer_sk) AS customer_sk_resolved, COUNT(product_sk) AS product_sk_resolved,
            COUNT(date_sk) AS date_sk_resolved FROM fact"""),
        "fk_orphans": _orphans(),
        "warehouse_churn_metric": _mart(f"""SELECT {CHURNED} AS churned,
            CAST(COUNT(*) - SUM(churn_flag) AS BIGINT) AS active, {RATE} AS churn_rate FROM cur"""),
        "fact_profile": query(p.fact(), """SELECT COUNT(*) AS transactions,
            MIN(transaction_date) AS first_date, MAX(transaction_date) AS last_date,
            COUNT(DISTINCT customer_id) AS unique_customers,
            CAST(SUM(amount) AS DOUBLE) AS total_amount, CAST(MIN(amount) AS DOUBLE) AS min_amount,
            CAST(MAX(amount) AS DOUBLE) AS max_amount FROM fact"""),
        "fact_value_counts": query(p.fact(), _union([
            f"SELECT '{c}' AS \"column\", {c} AS value, COUNT(*) AS n, "
            f"{share('COUNT(*)', '(SELECT COUNT(*) FROM fact)', 1)} AS pct FROM fact "
            f"WHERE {c} IS NOT NULL GROUP BY {c}" for c in ("transaction_type", "channel")])),
        "fact_amount_stats": query(
            p.fact() + [("lists", f"SELECT {p.sorted_list('amount')} AS l FROM fact")],
            f"""SELECT 'amount' AS "column", COUNT(amount) AS count,
            {round_even('AVG(amount)', 2)} AS mean,
            {round_even('stddev_samp(CAST(amount AS DOUBLE))', 2)} AS std,
            {round_even('MIN(amount)', 2)} AS min, """ + ", ".join(
                f"(SELECT {round_even(p.quantile('l', x), 2)} FROM lists) AS {n}"
                for x, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")))
            + f", {round_even('MAX(amount)', 2)} AS max FROM fact"),
        "dim_date_years": query(p.dim_date(), "SELECT DISTINCT year FROM dimd"),
        "dim_date_profile": query(p.dim_date(), """SELECT COUNT(*) AS days,
            MIN(full_date) AS first_date, MAX(full_date) AS last_date,
            COUNT(DISTINCT year) AS years, COUNT(*) FILTER (WHERE is_weekend = 1) AS weekend_days,
            COUNT(*) FILTER (WHERE is_weekend = 0) AS weekdays FROM dimd"""),
        "churn_reason_dist": query(p.churn_reasons(), f"""SELECT churn_reason, COUNT(*) AS customers,
            {share('COUNT(*)', '(SELECT COUNT(*) FROM dimr WHERE churn_flag = 1)', 1)} AS pct
            FROM dimr WHERE churn_flag = 1 GROUP BY churn_reason"""),
        "q1": _mart(f"""SELECT geography, gender, COUNT(DISTINCT customer_id) AS total_customers,
            {CHURNED} AS churned_customers,
            CAST(COUNT(DISTINCT customer_id) - SUM(churn_flag) AS BIGINT) AS active_customers,
            {pct('SUM(churn_flag)', 'COUNT(DISTINCT customer_id)')} AS churn_rate_pct
            FROM cur GROUP BY geography, gender"""),
        "q2": query(p.dim_customer() + [("g", f"""SELECT geography, age_group, credit_tier,
                COUNT(DISTINCT customer_id) AS churned_customers, SUM(balance) AS b,
                {p.mean_money('balance')} AS avg_balance_per_churner
                FROM cur WHERE churn_flag = 1 GROUP BY ALL""")],
            f"""SELECT geography, age_group, credit_tier, churned_customers,
            {money('b')} AS total_balance_at_risk, avg_balance_per_churner,
            {pct(p.cents('b'), p.cents('(SELECT SUM(b) FROM g)'))} AS pct_of_total_at_risk
            FROM g ORDER BY b DESC, geography, age_group, credit_tier LIMIT 20"""),
        "q3": _q3(),
        "q4": _q4(),
        "q5": _q5(),
        "sql_monthly": query(p.fact() + p.dim_date(), """SELECT d.year, d.month, d.year_month,
            COUNT(*) AS transactions, COUNT(DISTINCT f.customer_sk) AS customers,
            CAST(SUM(f.churn_flag) AS BIGINT) AS churned_txns
            FROM fact f JOIN dimd d ON f.date_sk = d.date_sk GROUP BY ALL"""),
        "q6": _mart("""SELECT customer_id, surname, geography, age, age_group, credit_tier, tenure,
            tenure_band, CAST(balance AS DOUBLE) AS balance, num_of_products, is_active_member,
            risk_score, risk_category, CAST(estimated_ltv AS DOUBLE) AS estimated_ltv,
            CASE WHEN risk_score >= 7 THEN 'Immediate outreach required'
            WHEN risk_score >= 5 THEN 'Schedule retention call'
            WHEN risk_score >= 3 THEN 'Send engagement email' ELSE 'Monitor' END
            AS recommended_action FROM cur c WHERE churn_flag = 0 AND risk_score >= 3
            ORDER BY c.risk_score DESC, c.balance DESC, c.customer_id LIMIT 100"""),
        "q7": _mart(f"""SELECT credit_tier, high_value_flag, COUNT(*) AS total_customers,
            {CHURNED} AS churned, {RATE} AS churn_rate_pct, {p.mean_money('balance')} AS avg_balance,
            {p.mean_money('estimated_ltv')} AS avg_ltv FROM cur GROUP BY ALL"""),
        "q8": _mart(f"""SELECT CASE is_active_member WHEN 1 THEN 'Active Member'
            ELSE 'Inactive Member' END AS member_status, COUNT(*) AS total_customers,
            {CHURNED} AS churned, {RATE} AS churn_rate_pct,
            {p.mean_money('balance')} AS avg_balance FROM cur GROUP BY is_active_member"""),
        "balance_rank_within_group": _mart("""SELECT customer_id, is_active_member,
            CAST(balance AS DOUBLE) AS balance, churn_flag, geography, row_number() OVER (
            PARTITION BY is_active_member ORDER BY cur.balance DESC, customer_id)
            AS balance_rank_within_group FROM cur"""),
        "q9": _mart(f"""SELECT tenure_band, geography, COUNT(*) AS total_customers,
            {CHURNED} AS churned, {RATE} AS churn_rate_pct, {p.mean_money('balance')} AS avg_balance,
            {pct('SUM(risk_score)', 'COUNT(risk_score)', 1)} AS avg_risk_score
            FROM cur GROUP BY tenure_band, geography"""),
        "q10": _mart(f"""SELECT COUNT(DISTINCT customer_id) AS total_customers,
            {CHURNED} AS total_churned,
            CAST(COUNT(DISTINCT customer_id) - SUM(churn_flag) AS BIGINT) AS total_active,
            {RATE} AS overall_churn_rate_pct,
            {money('SUM(CASE WHEN churn_flag = 1 THEN balance ELSE 0 END)')} AS total_revenue_at_risk,
            {p.mean_money('CASE WHEN churn_flag = 1 THEN balance END')} AS avg_churner_balance,
            COUNT(*) FILTER (WHERE risk_category = 'Critical Risk' AND churn_flag = 0)
            AS critical_risk_active_count,
            COUNT(*) FILTER (WHERE risk_category = 'High Risk' AND churn_flag = 0)
            AS high_risk_active_count, {p.mean_money('estimated_ltv')} AS avg_customer_ltv,
            {money('SUM(estimated_ltv)')} AS total_portfolio_ltv FROM cur"""),
        "univariate_stats": _univariate(),
        "credit_tier_dist": _banded_counts('"CreditScore"', p.CREDIT_RANGED),
        "age_group_churn": _banded_churn('"Age"', p.AGE),
        "balance_segments": _balance_segments(),
        "churn_by_zero_balance": query(p.raw(), _churn_table("raw", '("Balance" = 0)', "zero_balance")),
        "distinct_tenures": query(p.raw(), 'SELECT DISTINCT "Tenure" FROM raw WHERE "Tenure" IS NOT NULL'),
        "churn_by_tenure": query(p.raw(), _churn_table("raw", '"Tenure"', "tenure")),
        "churn_by_products": query(p.raw(), _churn_table("raw", '"NumOfProducts"', "num_of_products")),
        "churn_by_active": query(p.raw(), _churn_table("raw", '"IsActiveMember"', "is_active_member")),
        "hist_credit_score": _histogram("CreditScore", 40),
        "hist_age": _histogram("Age", 30),
        "hist_balance": _histogram("Balance", 40, '"Balance" > 0'),
        "hist_balance_by_churn": _histogram("Balance", 30, '"Balance" > 0', "Exited"),
        "box_credit_by_churn": _box(),
        "corr_matrix": _corr_matrix(),
        "corr_with_churn": _corr_with_churn(),
        "pivot_geo_gender": _pivot('"Geography"', "geography", '"Gender"',
                                   {"'Female'": "female", "'Male'": "male"}),
        "pivot_age_tenure": _pivot(p.bands('"Age"', *p.AGE), "age_group",
                                   p.bands('"Tenure"', *p.TENURE),
                                   {f"'{b}'": b for b in p.TENURE[1]}),
        "pivot_products_active": _pivot('"NumOfProducts"', "num_of_products", '"IsActiveMember"',
                                        {"0": "inactive", "1": "active"}),
        "pivot_products_active_counts": query(p.raw(), """SELECT "NumOfProducts" AS num_of_products,
            nullif(COUNT("CustomerId") FILTER (WHERE "IsActiveMember" = 0), 0) AS inactive,
            nullif(COUNT("CustomerId") FILTER (WHERE "IsActiveMember" = 1), 0) AS active
            FROM raw WHERE "NumOfProducts" IS NOT NULL GROUP BY "NumOfProducts" """),
        "pivot_credit_value": _pivot(
            p.bands('"CreditScore"', *p.CREDIT), "credit_tier",
            """CASE WHEN "Balance" > 100000 THEN 'High Value' ELSE 'Standard' END""",
            {"'High Value'": "high_value", "'Standard'": "standard"}),
    }
    # The export holds the rows of the report.
    return found | {"report_export": found["q1"]}
