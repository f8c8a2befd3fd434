from __future__ import annotations

import random
from datetime import date, datetime

import pytest

from spendscore import schemas
from spendscore.config import SCORE_RULES
from spendscore.operators import gold, silver

DAY = date(2024, 4, 1)
RATIOS = ("discretionary_ratio", "fixed_commitment_ratio", "salary_to_spend_ratio",
          "volatility_index", "recurring_spend_ratio")


def score_of(spark, *values, **options):
    df = spark.createDataFrame(
        [values], ", ".join(f"{name} double" for name in RATIOS)
    )
    return gold.apply_rules(df, **options).first()["sds_score"]


HARMLESS = (0.0, 0.0, 2.0, 0.0, 1.0)


@pytest.mark.parametrize(
    ("position", "at", "beyond", "points"),
    [(0, 0.5, 0.5000001, 50), (1, 0.6, 0.6000001, 100), (2, 1.0, 0.9999999, 150),
     (3, 20000.0, 20000.0001, 75), (4, 0.2, 0.1999999, 25)],
)
def test_thresholds_are_strict(spark, position, at, beyond, points):
    def with_value(value):
        return [value if i == position else v for i, v in enumerate(HARMLESS)]

    assert score_of(spark, *with_value(at)) == 650
    assert score_of(spark, *with_value(beyond)) == 650 - points
    assert score_of(spark, *with_value(None)) == 650  # unknown costs nothing


def test_scores_that_the_tables_do_not_reach(spark):
    assert score_of(spark, 0.0, 0.7, 2.0, 0.0, 0.0) == 525
    assert score_of(spark, 0.0, 0.7, 2.0, 30000.0, 0.0) == 450
    assert score_of(spark, 1.0, 1.0, 0.0, 30000.0, 0.0) == 250


def test_score_stays_in_bounds(spark):
    assert score_of(spark, *HARMLESS, base=2000) == 900
    assert score_of(spark, 1.0, 1.0, 0.0, 30000.0, 0.0, base=100) == 0


def test_leaving_a_rule_out_never_lowers_a_score(spark):
    rng = random.Random(5)
    for _ in range(5):
        values = [rng.uniform(0, 2) * (20000 if i == 3 else 1) for i in range(5)]
        full = score_of(spark, *values)
        for rule in SCORE_RULES:
            rest = [other for other in SCORE_RULES if other is not rule]
            assert score_of(spark, *values, rules=rest) >= full


@pytest.fixture
def salary(spark):
    def make(*rows):
        return spark.createDataFrame(list(rows), "customer_id int, salary_amount double")

    return make


def test_summary_by_hand(debit, salary):
    df = debit((1, "2024-01-01", 100.0, "Rent"), (1, "2024-01-02", 50.0, "Subscriptions"),
               (1, "2024-01-02", 30.0, "Misc. Discretionary"), (1, "2024-01-03", 20.0, "Other"))
    row = gold.gold_summary(df, salary((1, 100.0), (1, 300.0), (9, 5.0))).collect()
    assert len(row) == 1  # a salary without a debit has no score
    row = row[0].asDict()
    assert row["total_spend"] == 200.0 and row["avg_salary"] == 200.0 and row["total_txns"] == 4
    assert (row["subs"], row["misc"], row["rent"], row["utilities"], row["credit"]) == (
        50.0, 30.0, 100.0, 0.0, 0.0,
    )
    assert row["discretionary_ratio"] == pytest.approx(0.4)
    assert row["fixed_commitment_ratio"] == pytest.approx(100 / 600)
    assert row["salary_to_spend_ratio"] == pytest.approx(3.0)
    assert row["recurring_spend_ratio"] == 0.0


def test_no_salary_escapes_one_rule_and_meets_another(debit, salary):
    row = gold.gold_score(debit((1, "2024-01-01", 100.0, "Rent")), salary((2, 1.0)), DAY).first()
    assert row["fixed_commitment_ratio"] is None and row["salary_to_spend_ratio"] == 0.0
    assert row["sds_score"] == 650 - 150 - 25 and row["score_month"] == "2024-04"


def test_zero_spend_gives_null_ratios(debit, salary):
    df = debit((1, "2024-01-01", 10.0, "Rent"), (1, "2024-01-01", -10.0, "Other"))
    row = gold.gold_summary(df, salary((1, 5.0))).first()
    assert row["discretionary_ratio"] is None and row["salary_to_spend_ratio"] is None


def test_unknown_customer_beside_customer_zero(debit, salary):
    df = debit((None, "2024-01-01", 5.0, "Rent"), (None, "2024-01-02", 50.0, "Rent"),
               (0, "2024-01-01", 7.0, "Rent"), (0, "2024-01-02", 8.0, "Rent"))
    pay = salary((None, 100.0), (0, 10.0))
    rows = sorted(gold.gold_summary(df, pay).collect(), key=lambda r: r["total_spend"])
    assert [r["customer_id"] for r in rows] == [0, 0]
    assert rows[1]["avg_salary"] == 0.0 and rows[1]["volatility_index"] == 0.0
    assert rows[0]["avg_salary"] == 10.0 and rows[0]["volatility_index"] > 0
    kept = gold.gold_summary(df, pay, include_key=False)
    assert {r["customer_id"] for r in kept.collect()} == {None, 0}


def test_fused_features_equal_joined_ones(spark, debit):
    rng = random.Random(11)
    labels = ["Rent", "Subscriptions", "Other", "Recurring"]
    rows = [(rng.choice([None, 0, 1, 2]), f"2024-01-{rng.randint(1, 9):02d}",
             float(rng.randint(1, 500)), rng.choice(labels)) for _ in range(200)]
    df = debit(*rows)
    df.createOrReplaceTempView("debits")
    joined = spark.sql("""
        SELECT f.*, v.volatility_index FROM (
            SELECT customer_id, sum(amount) AS total_spend,
                sum(CASE WHEN category = 'Subscriptions' THEN amount END) AS subs,
                sum(CASE WHEN category = 'Misc. Discretionary' THEN amount END) AS misc,
                sum(CASE WHEN category = 'Rent' THEN amount END) AS rent,
                sum(CASE WHEN category = 'Utilities' THEN amount END) AS utilities,
                sum(CASE WHEN category = 'Credit Card Payment' THEN amount END) AS credit,
                count(*) AS total_txns, count_if(category = 'Recurring') AS recurring_txns
            FROM debits GROUP BY customer_id) f
        LEFT JOIN (SELECT customer_id, stddev(daily) AS volatility_index FROM (
            SELECT customer_id, sum(amount) AS daily FROM debits GROUP BY customer_id, txn_date)
            GROUP BY customer_id) v ON f.customer_id = v.customer_id""")
    fused = gold.customer_features(df).select(*joined.columns)
    key = lambda r: repr(r["customer_id"])
    for left, right in zip(sorted(fused.collect(), key=key), sorted(joined.collect(), key=key), strict=True):
        assert left.asDict() == pytest.approx(right.asDict())


def test_corrected_score_counts_repeats_and_repayments(debit, salary):
    df = debit((1, "2024-01-01", 100.0, "Credit Repayment", "visa"),
               (1, "2024-01-02", 100.0, "Credit Repayment", "visa"),
               (1, "2024-01-02", 100.0, "Other", "x"), (2, "2024-01-02", 1.0, "Other", "x"))
    pay = salary((1, 1000.0), (2, 1000.0))
    rows = {r["customer_id"]: r for r in gold.gold_score_corrected(df, pay, DAY).collect()}
    assert rows[1]["recurring_spend_ratio"] == pytest.approx(2 / 3)
    assert rows[1]["fixed_commitment_ratio"] == pytest.approx(200 / 3000)
    assert rows[2]["recurring_spend_ratio"] == 0.0
    assert rows[1]["sds_score"] == 650 and rows[2]["sds_score"] == 625


def test_audit_columns(debit, salary):
    score = gold.gold_score(
        debit((1, "2024-01-01", 1.0, "Rent"), (2, "2024-01-01", 1.0, "Rent")), salary((1, 1.0)), DAY
    )
    assert score.columns == schemas.SCORE.names
    audited = gold.add_audit(score, at=datetime(2024, 4, 1, 6, 30))
    assert audited.columns == schemas.SCORE_AUDIT.names
    rows = audited.collect()
    assert len({r["calculation_id"] for r in rows}) == 2
    assert {r["calculation_time"] for r in rows} == {"2024-04-01T06:30:00"}
    assert {r["calculated_by"] for r in rows} == {"auto_pipeline"}


def test_typed_debit_accepts_text(spark):
    df = spark.createDataFrame([("2024-01-05", "1.5"), ("?", "?")], "txn_date string, amount string")
    assert [tuple(r) for r in gold.typed_debit(df).collect()] == [(date(2024, 1, 5), 1.5), (None, None)]


def test_unknown_options_are_refused(debit, salary):
    with pytest.raises(ValueError):
        gold.gold_summary(debit((1, "2024-01-01", 1.0, "Rent")), salary((1, 1.0)), recurring_from="x")


def test_silver_profile_total_agrees_with_gold(debit):
    df = debit((1, "2024-01-01", 1.0, "Rent"), (1, "2024-01-02", 2.0, "Rent"))
    assert silver.spend_profile(df).first()["total_spend"] == gold.customer_features(df).first()["total_spend"]
