"""Plain SQL for the registered queries, written apart from the operators."""

from __future__ import annotations

from spendscore.plans.queries import MONTHS

_MERCHANTS = """(VALUES (0,'Zillow'),(1,'RentPay'),(2,'Landlord LLC'),(3,'BC Hydro'),
  (4,'Enbridge Gas'),(5,'TELUS Mobility'),(6,'Netflix'),(7,'Spotify'),(8,'Amazon Prime Video'),
  (9,'Zomato'),(10,'Costco'),(11,'Uber Eats'),(12,'UBER Trip'),(13,'Swiggy'),(14,'Visa Payment'),
  (15,'AMEX'),(16,'EMI Portal'),(17,'Amazon Marketplace'),(18,'Shopping Mall'),(19,'Flipkart'),
  (20,'BigBazaar'),(21,'Myntra'),(22,'Flights R Us'),(23,'Premier Gym'),(24,'Corner Store'),
  (25,'Enbrdge'),(26,CAST(NULL AS VARCHAR))) AS m(idx, merchant)"""

_STAMP = "DATE '2024-04-01' AS ingestion_date"

# The category rules in match order.
_RULES = """WHEN regexp_matches(merchant, 'zillow|rentpay|landlord') THEN 'Rent'
            WHEN regexp_matches(merchant, 'hydro|enbridge|telus') THEN 'Utilities'
            WHEN regexp_matches(merchant, 'netflix|spotify|amazon prime') THEN 'Subscriptions'
            WHEN regexp_matches(merchant, 'zomato|costco|uber eats|uber|swiggy') THEN 'Food & Groceries'
            WHEN regexp_matches(merchant, 'visa|amex|emi') THEN 'Credit Repayment'
            WHEN regexp_matches(merchant, 'amazon|shopping|flipkart|uber|bigbazaar|myntra|flights') THEN 'Misc. Discretionary'"""

# Common table expressions, each naming the ones it is built on.
_TABLES: dict[str, tuple[tuple[str, ...], str]] = {
    "transactions": (
        (),
        f"""SELECT CAST(o.o_custkey AS INT) AS customer_id,
            CAST(o.o_orderdate AS DATE) AS txn_date,
            CAST(floor(l.l_extendedprice * 25) / 100 AS DOUBLE) AS amount,
            CASE WHEN l.l_returnflag = 'R' THEN 'credit' ELSE 'debit' END AS txn_type,
            lower(m.merchant) AS merchant,
            CASE l.l_linenumber % 3 WHEN 0 THEN 'pos' WHEN 1 THEN 'online' ELSE 'mobile' END AS channel,
            CAST(5000 + l.l_suppkey % 100 AS INT) AS mcc_code,
            {_STAMP}
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
        JOIN {_MERCHANTS} ON m.idx = l.l_partkey % 27""",
    ),
    "salary": (
        (),
        f"""SELECT CAST(c.c_custkey AS INT) AS customer_id,
            CASE WHEN c.c_custkey % 10 <> 0 THEN c.c_acctbal * CAST(16 AS DOUBLE) + CAST(p.bump AS DOUBLE) END
                AS salary_amount,
            p.pay_date, {_STAMP}
        FROM customer c CROSS JOIN (VALUES (0, DATE '2024-01-31'), (500, DATE '2024-02-29'),
            (1000, DATE '2024-03-31')) AS p(bump, pay_date)""",
    ),
    "subs": (
        (),
        """SELECT c_custkey AS customer_id,
            CASE c_custkey % 4 WHEN 0 THEN 'Netflix' WHEN 1 THEN 'Spotify'
                WHEN 2 THEN 'Amazon Prime' ELSE 'Gym' END AS service_name,
            CAST(999 + 100 * c_nationkey AS DOUBLE) / 100 AS amount,
            CASE WHEN c_nationkey % 2 = 0 THEN 'monthly' ELSE 'yearly' END AS frequency
        FROM customer""",
    ),
    "statements": (
        (),
        f"""SELECT CAST(o_custkey AS INT) AS customer_id,
            CAST(o_orderdate AS DATE) AS statement_date,
            o_totalprice AS total_due,
            CAST(floor(o_totalprice * 5) / 100 AS DOUBLE) AS minimum_due,
            CAST(trunc(floor(o_totalprice * (o_orderkey % 101)) / 100) AS INT) AS paid_amount,
            {_STAMP}
        FROM orders""",
    ),
    "debit": (
        ("transactions",),
        f"""SELECT *, CASE
            {_RULES}
            ELSE 'Other' END AS category
        FROM transactions WHERE txn_type = 'debit'""",
    ),
    "daily": (
        ("debit",),
        """SELECT customer_id, txn_date, sum(amount) AS daily_spend
        FROM debit GROUP BY customer_id, txn_date""",
    ),
    "vol": (
        ("daily",),
        "SELECT customer_id, stddev_samp(daily_spend) AS vol FROM daily GROUP BY customer_id",
    ),
    "recurring": (
        ("debit",),
        """SELECT customer_id, category, merchant, count(txn_type) AS transaction_count
        FROM debit GROUP BY customer_id, category, merchant HAVING count(txn_type) > 1""",
    ),
    "monthly": (
        ("debit",),
        """SELECT customer_id, merchant, category, CAST(year(txn_date) AS INT) AS year,
            CAST(month(txn_date) AS INT) AS month, sum(amount) AS monthly_spend,
            strftime(min(txn_date), '%Y_%b') AS year_month
        FROM debit GROUP BY customer_id, merchant, category, year(txn_date), month(txn_date)""",
    ),
    "salaries": (
        ("salary",),
        "SELECT customer_id, avg(salary_amount) AS avg_salary FROM salary GROUP BY customer_id",
    ),
    "features": (
        ("debit",),
        """SELECT customer_id, sum(amount) AS total_spend,
            sum(CASE WHEN category = 'Subscriptions' THEN amount END) AS subs,
            sum(CASE WHEN category = 'Misc. Discretionary' THEN amount END) AS misc,
            sum(CASE WHEN category = 'Rent' THEN amount END) AS rent,
            sum(CASE WHEN category = 'Utilities' THEN amount END) AS utilities,
            sum(CASE WHEN category = 'Credit Card Payment' THEN amount END) AS credit,
            sum(CASE WHEN category = 'Credit Repayment' THEN amount END) AS repaid,
            count(*) AS total_txns,
            CAST(sum(CASE WHEN category = 'Recurring' THEN 1 ELSE 0 END) AS BIGINT) AS recurring_txns
        FROM debit GROUP BY customer_id""",
    ),
    "filled": (
        ("features", "vol", "salaries"),
        """SELECT f.customer_id, total_spend, coalesce(avg_salary, 0) AS avg_salary,
            coalesce(subs, 0) AS subs, coalesce(misc, 0) AS misc, coalesce(rent, 0) AS rent,
            coalesce(utilities, 0) AS utilities, coalesce(credit, 0) AS credit,
            recurring_txns, total_txns, coalesce(vol, 0) AS volatility_index
        FROM features f LEFT JOIN vol v ON f.customer_id = v.customer_id
        LEFT JOIN salaries s ON f.customer_id = s.customer_id""",
    ),
    # the same with the credit label the rules emit and repeats by merchant
    "filled_corrected": (
        ("features", "vol", "salaries", "recurring"),
        """SELECT f.customer_id, total_spend, coalesce(avg_salary, 0) AS avg_salary,
            coalesce(subs, 0) AS subs, coalesce(misc, 0) AS misc, coalesce(rent, 0) AS rent,
            coalesce(utilities, 0) AS utilities, coalesce(repaid, 0) AS credit,
            coalesce(r.txns, 0) AS recurring_txns, total_txns, coalesce(vol, 0) AS volatility_index
        FROM features f LEFT JOIN vol v ON f.customer_id = v.customer_id
        LEFT JOIN salaries s ON f.customer_id = s.customer_id
        LEFT JOIN (SELECT customer_id, sum(transaction_count) AS txns FROM recurring
            GROUP BY customer_id) r ON f.customer_id = r.customer_id""",
    ),
}


def _ratios(filled: str) -> str:
    return f"""SELECT *, (subs + misc) / nullif(total_spend, 0) AS discretionary_ratio,
        (rent + utilities + credit) / nullif(avg_salary * 3, 0) AS fixed_commitment_ratio,
        (avg_salary * 3) / nullif(total_spend, 0) AS salary_to_spend_ratio,
        CAST(recurring_txns AS DOUBLE) / total_txns AS recurring_spend_ratio
    FROM {filled}"""


def _scores(ratios: str) -> str:
    return f"""SELECT *, CAST(least(900, greatest(0, 650
        - CASE WHEN discretionary_ratio > 0.5 THEN 50 ELSE 0 END
        - CASE WHEN fixed_commitment_ratio > 0.6 THEN 100 ELSE 0 END
        - CASE WHEN salary_to_spend_ratio < 1 THEN 150 ELSE 0 END
        - CASE WHEN volatility_index > 20000 THEN 75 ELSE 0 END
        - CASE WHEN recurring_spend_ratio < 0.2 THEN 25 ELSE 0 END)) AS INT) AS sds_score,
        '2024-04' AS score_month
    FROM {ratios}"""


_TABLES |= {
    "ratios": (("filled",), _ratios("filled")),
    "ratios_corrected": (("filled_corrected",), _ratios("filled_corrected")),
    "score": (("ratios",), _scores("ratios")),
    "score_corrected": (("ratios_corrected",), _scores("ratios_corrected")),
    "quartiles": (
        ("score",),
        """SELECT sds_score, count(*) AS n, quantile_cont(total_spend, 0.25) AS q1,
            quantile_cont(total_spend, 0.5) AS median, quantile_cont(total_spend, 0.75) AS q3
        FROM score GROUP BY sds_score""",
    ),
    "fenced": (
        ("score", "quartiles"),
        """SELECT s.customer_id, s.total_spend, q.*,
            s.total_spend BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
        FROM score s JOIN quartiles q ON s.sds_score = q.sds_score""",
    ),
    "examples": (
        (),
        """SELECT * FROM (VALUES (0,'Rent','zillow'),(1,'Rent','rentpay'),(2,'Rent','landlord'),
            (3,'Utilities','bc hydro'),(4,'Utilities','enbridge'),(5,'Utilities','telus'),
            (6,'Subscriptions','netflix'),(7,'Subscriptions','spotify'),
            (8,'Subscriptions','amazon prime'),(9,'Food & Groceries','zomato'),
            (10,'Food & Groceries','costco'),(11,'Food & Groceries','uber eats'),
            (12,'Credit Repayment','visa'),(13,'Credit Repayment','amex'),
            (14,'Credit Repayment','emi portal'),(15,'Misc. Discretionary','amazon'),
            (16,'Misc. Discretionary','shopping'),(17,'Misc. Discretionary','flights')
        ) AS e(example, label, name)""",
    ),
    "merchants": (
        ("debit",),
        "SELECT merchant, count(*) AS n_rows FROM debit GROUP BY merchant",
    ),
}

_WORDS = r"unnest(regexp_extract_all({0}, '\b\w\w+\b'))"
_TRIGRAMS = (
    "unnest(list_transform(range(1, greatest(length({0}) - 1, 1)), lambda i: substr({0}, i, 3)))"
)


def _nearest(tokens: str) -> tuple[tuple[str, ...], str]:
    return (
        ("examples", "merchants"),
        f"""SELECT m.merchant, m.n_rows,
            CASE WHEN m.merchant IS NULL THEN NULL ELSE coalesce(b.label, 'Rent') END AS category,
            CASE WHEN m.merchant IS NULL THEN NULL ELSE coalesce(b.similarity, 0) END AS similarity
        FROM merchants m LEFT JOIN (
            WITH et AS (SELECT example, label, {tokens.format('name')} AS token FROM examples),
            etf AS (SELECT example, label, token, count(*) AS tf FROM et GROUP BY ALL),
            idf AS (SELECT token, ln(19.0 / (1 + count(*))) + 1 AS idf FROM etf GROUP BY token),
            ew AS (SELECT example, label, token, tf * idf AS w FROM etf JOIN idf USING (token)),
            el AS (SELECT example, sqrt(sum(w * w)) AS len FROM ew GROUP BY example),
            mt AS (SELECT merchant, {tokens.format('merchant')} AS token FROM merchants),
            mw AS (SELECT merchant, token, count(*) * any_value(idf) AS w
                FROM mt JOIN idf USING (token) GROUP BY merchant, token),
            ml AS (SELECT merchant, sqrt(sum(w * w)) AS len FROM mw GROUP BY merchant),
            sim AS (SELECT mw.merchant, ew.example, ew.label,
                    round(sum(mw.w * ew.w) / (any_value(ml.len) * any_value(el.len)), 12) AS similarity
                FROM mw JOIN ew USING (token) JOIN ml ON ml.merchant = mw.merchant
                JOIN el ON el.example = ew.example
                GROUP BY mw.merchant, ew.example, ew.label)
            SELECT *, row_number() OVER (PARTITION BY merchant
                ORDER BY similarity DESC, example) AS rk FROM sim
        ) b ON b.merchant = m.merchant AND b.rk = 1""",
    )


_TABLES |= {"nearest_words": _nearest(_WORDS), "nearest_trigrams": _nearest(_TRIGRAMS)}

_SUMMARY = """round(total_spend, 2) AS total_spend, round(avg_salary, 6) AS avg_salary,
    round(subs, 2) AS subs, round(misc, 2) AS misc, round(rent, 2) AS rent,
    round(utilities, 2) AS utilities, round(credit, 2) AS credit, recurring_txns, total_txns,
    round(volatility_index, 4) AS volatility_index"""
# "+ 0.0" because 0 / negative salary is -0.0 here, while Spark's round gives 0.0
_RATIOS = """round(discretionary_ratio, 6) AS discretionary_ratio,
    round(fixed_commitment_ratio, 6) + 0.0 AS fixed_commitment_ratio,
    round(salary_to_spend_ratio, 6) AS salary_to_spend_ratio,
    round(recurring_spend_ratio, 6) AS recurring_spend_ratio"""
_SCORE = f"""customer_id, round(total_spend, 2) AS total_spend, {_RATIOS},
    round(volatility_index, 4) AS volatility_index, sds_score, score_month"""
_SALARY = "customer_id, round(salary_amount, 2) AS salary_amount, pay_date, ingestion_date"
_FAR = "CASE WHEN similarity < 0.1 THEN 'Other' ELSE category END AS category"


def _pivot(aggregate: str) -> str:
    columns = ", ".join(
        f"round({aggregate.format(month)}, 2) AS \"{month}\"" for month in MONTHS
    )
    return f"SELECT customer_id, {columns} FROM monthly_ranked GROUP BY customer_id"


_TABLES["monthly_ranked"] = (
    ("monthly",),
    """SELECT *, row_number() OVER (PARTITION BY customer_id, year_month
        ORDER BY merchant NULLS FIRST, category) AS rk FROM monthly""",
)


def _pair(a: str, b: str) -> str:
    return f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM score"


_CORRELATED = ["total_spend", "discretionary_ratio", "salary_to_spend_ratio", "sds_score"]

_BODIES: dict[str, tuple[tuple[str, ...], str]] = {
    "scan_subscriptions": (("subs",), "SELECT * FROM subs"),
    "bronze_salary": (
        ("salary",),
        """SELECT customer_id, round(salary_amount, 2) AS salary_amount, pay_date, ingestion_date
        FROM salary""",
    ),
    "bronze_transactions": (("transactions",), "SELECT * FROM transactions"),
    "bronze_subscriptions": (("subs",), f"SELECT *, {_STAMP} FROM subs"),
    "bronze_statements": (("statements",), "SELECT * FROM statements"),
    "bronze_statements_csv": (("statements",), "SELECT * FROM statements"),
    "bronze_transactions_text": (
        ("transactions",),
        """SELECT * REPLACE (CASE WHEN txn_type = 'debit' THEN amount END AS amount)
        FROM transactions""",
    ),
    "debit_only": (
        ("transactions",),
        "SELECT * FROM transactions WHERE txn_type = 'debit'",
    ),
    "categorize": (("debit",), "SELECT * FROM debit"),
    "stream_debit": (("debit",), "SELECT * FROM debit"),
    "silver_rows": (
        ("debit",),
        """SELECT *, CAST(year(txn_date) AS INT) AS year, CAST(month(txn_date) AS INT) AS month
        FROM debit""",
    ),
    "daily_spend": (
        ("daily",),
        "SELECT customer_id, txn_date, round(daily_spend, 2) AS daily_spend FROM daily",
    ),
    "volatility": (("vol",), "SELECT customer_id, round(vol, 6) AS spend_volatility FROM vol"),
    "recurring_merchants": (("recurring",), "SELECT * FROM recurring"),
    "total_spend_window": (
        ("debit",),
        "SELECT *, round(sum(amount) OVER (PARTITION BY customer_id), 2) AS total_spend FROM debit",
    ),
    "spend_windows": (
        ("debit",),
        """SELECT customer_id, category, txn_date, amount, round(sum(amount) OVER recent, 2) AS three_month_category_spend,
            round(sum(amount) OVER (PARTITION BY customer_id), 2) AS total_spend FROM debit
        WINDOW recent AS (PARTITION BY customer_id, category ORDER BY txn_date, amount ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
    ),
    "rolling_3_rows": (
        ("debit",),
        """SELECT customer_id, category, txn_date, amount,
            round(sum(amount) OVER (PARTITION BY customer_id, category ORDER BY txn_date, amount
                ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 2) AS three_month_category_spend
        FROM debit""",
    ),
    "table_append": (
        ("salary",),
        f"SELECT {_SALARY} FROM salary UNION ALL SELECT {_SALARY} FROM salary",
    ),
    "table_replace_partition": (
        ("salary",),
        f"""SELECT {_SALARY} FROM salary UNION ALL
        SELECT * REPLACE (ingestion_date + 1 AS ingestion_date) FROM (SELECT {_SALARY} FROM salary)""",
    ),
    "table_since": (
        ("salary",),
        f"""SELECT * REPLACE (ingestion_date + 1 AS ingestion_date)
        FROM (SELECT {_SALARY} FROM salary)""",
    ),
    "table_merge_schema": (
        ("salary",),
        f"""SELECT *, CAST(NULL AS INT) AS pay_year FROM (SELECT {_SALARY} FROM salary) UNION ALL
        SELECT * REPLACE (ingestion_date + 1 AS ingestion_date), CAST(year(pay_date) AS INT)
        FROM (SELECT {_SALARY} FROM salary)""",
    ),
    "table_overwrite": (("score",), f"SELECT {_SCORE} FROM score"),
    "typed_debit": (
        ("debit",),
        "SELECT customer_id, txn_date, CASE WHEN amount >= 100 THEN amount END AS amount, category FROM debit",
    ),
    "rolling_3_months": (
        ("debit",),
        """SELECT customer_id, category, CAST(idx // 12 AS INT) AS year,
            CAST(idx % 12 + 1 AS INT) AS month, round(spend, 2) AS monthly_spend,
            round(sum(spend) OVER (PARTITION BY customer_id, category ORDER BY idx
                RANGE BETWEEN 2 PRECEDING AND CURRENT ROW), 2) AS rolling_spend
        FROM (SELECT customer_id, category, year(txn_date) * 12 + month(txn_date) - 1 AS idx,
            sum(amount) AS spend FROM debit GROUP BY ALL)""",
    ),
    "monthly_spend": (
        ("monthly",),
        """SELECT customer_id, merchant, category, year, month,
            round(monthly_spend, 2) AS monthly_spend, year_month FROM monthly""",
    ),
    "pivot_months_sum": (
        ("monthly_ranked",),
        _pivot("sum(CASE WHEN year_month = '{0}' THEN monthly_spend END)"),
    ),
    "pivot_months_first": (
        ("monthly_ranked",),
        _pivot("max(CASE WHEN year_month = '{0}' AND rk = 1 THEN monthly_spend END)"),
    ),
    "spend_profile": (
        ("features", "vol", "recurring"),
        """SELECT f.customer_id, round(total_spend, 2) AS total_spend,
            round(vol, 6) AS spend_volatility, coalesce(r.n, 0) AS recurring_merchants
        FROM features f LEFT JOIN vol v ON f.customer_id = v.customer_id
        LEFT JOIN (SELECT customer_id, count(*) AS n FROM recurring GROUP BY customer_id) r
            ON f.customer_id = r.customer_id""",
    ),
    "profile_fanout_size": (
        ("features", "recurring"),
        """SELECT CAST(sum(total_txns) AS BIGINT) AS debit_rows,
            CAST(sum(CAST(total_txns AS HUGEINT) * total_txns * greatest(coalesce(r.n, 0), 1))
                AS VARCHAR) AS joined_rows
        FROM features f LEFT JOIN (SELECT customer_id, count(*) AS n FROM recurring
            GROUP BY customer_id) r ON f.customer_id = r.customer_id""",
    ),
    "avg_salary": (
        ("salaries",),
        "SELECT customer_id, round(avg_salary, 6) AS avg_salary FROM salaries",
    ),
    "debit_features": (
        ("features",),
        """SELECT customer_id, round(total_spend, 2) AS total_spend, round(subs, 2) AS subs,
            round(misc, 2) AS misc, round(rent, 2) AS rent, round(utilities, 2) AS utilities,
            round(credit, 2) AS credit, total_txns, recurring_txns FROM features""",
    ),
    "gold_summary": (("ratios",), f"SELECT customer_id, {_SUMMARY}, {_RATIOS} FROM ratios"),
    "gold_ratios": (("ratios",), f"SELECT customer_id, {_RATIOS} FROM ratios"),
    "gold_score": (("score",), f"SELECT {_SCORE} FROM score"),
    "layered_score": (("score",), f"SELECT {_SCORE} FROM score"),
    "gold_score_corrected": (("score_corrected",), f"SELECT {_SCORE} FROM score_corrected"),
    "audit_check": (
        ("score",),
        """SELECT customer_id, sds_score, score_month, '2024-04-01T06:30:00' AS calculation_time,
            'auto_pipeline' AS calculated_by, CAST(1 AS INT) AS id_is_uuid FROM score""",
    ),
    "audit_ids": (("score",), "SELECT count(*) AS rows, count(*) AS ids FROM score"),
    "audit_log": (
        ("score",),
        f"""SELECT {_SCORE}, regexp_replace(md5(concat_ws('|', coalesce(CAST(customer_id AS VARCHAR), '?'), score_month, calculation_time)),
                '(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})', '\\1-\\2-\\3-\\4-\\5') AS calculation_id,
            calculation_time, 'auto_pipeline' AS calculated_by
        FROM score, (VALUES ('2024-04-01T06:30:00'), ('2024-04-01T18:00:00')) AS t(calculation_time)""",
    ),
    "score_histogram": (
        ("score",),
        "SELECT sds_score, count(*) AS customers FROM score GROUP BY sds_score",
    ),
    "ratio_counts": (
        ("score",),
        """SELECT round(discretionary_ratio, 6) AS discretionary_ratio, count(*) AS customers
        FROM score WHERE discretionary_ratio IS NOT NULL GROUP BY 1""",
    ),
    "ratio_buckets": (
        ("score",),
        """WITH edges AS (SELECT CAST(i AS INT) + 1 AS bucket, i / 10.0::DOUBLE AS low,
            CASE WHEN i < 10 THEN (i + 1) / 10.0::DOUBLE END AS high FROM range(0, 11) AS t(i))
        SELECT e.bucket, e.low, e.high, count(*) AS customers
        FROM score JOIN edges e ON discretionary_ratio >= e.low
            AND (e.high IS NULL OR discretionary_ratio < e.high)
        GROUP BY e.bucket, e.low, e.high""",
    ),
    "spend_boxstats": (
        ("fenced",),
        """SELECT sds_score, n, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
            round(min(total_spend) FILTER (inside), 2) AS lo,
            round(max(total_spend) FILTER (inside), 2) AS hi,
            count(*) FILTER (NOT inside) AS n_out
        FROM fenced GROUP BY sds_score, n, q1, median, q3""",
    ),
    "spend_outliers": (
        ("fenced",),
        """SELECT sds_score, customer_id, round(total_spend, 2) AS total_spend
        FROM fenced WHERE NOT inside""",
    ),
    "scatter_points": (
        ("score",),
        """SELECT round(salary_to_spend_ratio, 6) AS salary_to_spend_ratio, sds_score,
            round(discretionary_ratio, 6) AS discretionary_ratio FROM score""",
    ),
    "spend_share": (
        ("score",),
        """SELECT CASE WHEN discretionary_ratio > 0.5 THEN 'Discretionary'
                ELSE 'Non-Discretionary' END AS kind,
            round(sum(total_spend), 2) AS total_spend,
            round(sum(total_spend) * 100 / (SELECT sum(total_spend) FROM score), 6) AS percent
        FROM score GROUP BY 1""",
    ),
    "spend_share_by_ratio": (
        ("score",),
        """SELECT round(discretionary_ratio, 6) AS discretionary_ratio,
            round(sum(total_spend), 2) AS total_spend,
            round(sum(total_spend) * 100 / (SELECT sum(total_spend) FROM score), 6) AS percent
        FROM score GROUP BY 1""",
    ),
    "top_spenders": (
        ("score",),
        """SELECT customer_id, round(total_spend, 2) AS total_spend, sds_score
        FROM score ORDER BY score.total_spend DESC, customer_id LIMIT 5""",
    ),
    "correlations": (
        ("score",),
        " UNION ALL ".join(
            _pair(a, b) for i, a in enumerate(_CORRELATED) for b in _CORRELATED[i + 1 :]
        ),
    ),
    "nearest_category": (
        ("nearest_words",),
        """SELECT merchant, n_rows, category, round(similarity, 6) AS similarity
        FROM nearest_words""",
    ),
    "nearest_category_char3": (
        ("nearest_trigrams",),
        f"""SELECT merchant, n_rows, {_FAR}, round(similarity, 6) AS similarity
        FROM nearest_trigrams""",
    ),
    "label_nearest": (
        ("debit", "nearest_trigrams"),
        f"""SELECT d.customer_id, d.txn_date, d.amount, d.merchant, n.category
        FROM debit d JOIN (SELECT merchant, {_FAR} FROM nearest_trigrams) n
            ON d.merchant IS NOT DISTINCT FROM n.merchant""",
    ),
    "stream_daily_spend": (
        (),
        """SELECT CAST(user_id AS INT) AS customer_id, CAST(ts AS DATE) AS txn_date,
            round(sum(value), 2) AS daily_spend
        FROM events
        GROUP BY 1, 2
        HAVING CAST(ts AS DATE) + INTERVAL 1 DAY
            <= (SELECT max(ts) FROM events) - INTERVAL 2 DAY""",
    ),
}


def _needed(names: tuple[str, ...], seen: dict[str, str]) -> dict[str, str]:
    for name in names:
        if name not in seen:
            needs, body = _TABLES[name]
            _needed(needs, seen)
            seen[name] = body
    return seen


def _statement(needs: tuple[str, ...], body: str) -> str:
    tables = ",\n".join(f"{name} AS ({sql})" for name, sql in _needed(needs, {}).items())
    return f"WITH {tables}\nSELECT * FROM ({body})" if tables else body


_BODIES["stream_daily_spend_update"] = (
    (),
    """SELECT CAST(user_id AS INT) AS customer_id, CAST(ts AS DATE) AS txn_date,
        round(sum(value), 2) AS daily_spend FROM events GROUP BY 1, 2""",
)

_BODIES["table_widen_schema"] = (
    (),
    """SELECT CAST(c_custkey AS BIGINT) AS customer_id, CAST(floor(c_acctbal) AS DOUBLE) AS amount, CAST(NULL AS VARCHAR) AS c_mktsegment,
        DATE '2024-04-01' AS ingestion_date FROM customer
    UNION ALL SELECT c_custkey + 3000000000, CAST(c_acctbal AS DOUBLE), c_mktsegment, DATE '2024-04-02' FROM customer""",
)
_BODIES["rerun_after_failure"] = (
    ("transactions", "salary", "subs", "statements", "debit"),
    """SELECT 'salary_income' AS name, count(*) AS rows FROM salary UNION ALL SELECT 'transactions', count(*) FROM transactions
    UNION ALL SELECT 'subscriptions', count(*) FROM subs UNION ALL SELECT 'credit_card_statements', count(*) FROM statements
    UNION ALL SELECT 'debit_transactions', count(*) FROM debit""",
)

# Where a second query takes another way to the same rows, it has the same SQL.
for _other, _name in {
    "layered_histogram": "score_histogram", "reports_after_two_months": "score_histogram",
    "layered_pivot": "pivot_months_first", "stream_to_score": "gold_score",
    "features_incremental": "gold_summary", "spend_boxstats_selected": "spend_boxstats",
    "categorize_rules": "categorize", "nearest_category_table": "nearest_category",
    "stream_daily_spend_late": "stream_daily_spend_update", "stream_compacted": "stream_daily_spend_update",
}.items():
    _BODIES[_other] = _BODIES[_name]
for _name in ("total_spend_window", "rolling_3_rows", "spend_windows"):
    _BODIES[f"{_name}_heavy"] = _BODIES[_name]

ORACLE: dict[str, str] = {
    name: _statement(needs, body) for name, (needs, body) in _BODIES.items()
}
