from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from spendscore import schemas
from spendscore.config import PipelineConfig
from spendscore.operators import bronze
from spendscore.sources.tables import append_audit, read_table, write_table

FIRST, SECOND = date(2024, 4, 1), date(2024, 4, 2)


@pytest.fixture
def config(tmp_path):
    return PipelineConfig(str(tmp_path))


def salary(spark, day, *rows):
    df = spark.createDataFrame(list(rows), "customer_id int, salary_amount double")
    return bronze.conform_salary(df.withColumn("pay_date", F.lit("2024-03-31")), day)


def scores(spark, month, *customers):
    df = spark.createDataFrame([(c,) for c in customers], "customer_id int")
    return df.select(
        *[(F.col(f.name) if f.name == "customer_id" else F.lit(None).cast(f.dataType)).alias(f.name)
          for f in schemas.SCORE if f.name != "score_month"],
        F.lit(month).alias("score_month"),
    )


def put(df, config, mode="append"):
    write_table(df, config, "salary_income", mode=mode, partition_by=["ingestion_date"])


def test_append_twice_doubles(spark, config):
    put(salary(spark, FIRST, (1, 5.0)), config)
    put(salary(spark, FIRST, (1, 5.0)), config)
    assert read_table(spark, config, "salary_income").count() == 2


def test_replace_partition_keeps_other_days(spark, config):
    put(salary(spark, FIRST, (1, 5.0)), config)
    put(salary(spark, SECOND, (2, 5.0), (3, 5.0)), config, "replace_partition")
    put(salary(spark, SECOND, (4, 6.0)), config, "replace_partition")
    table = read_table(spark, config, "salary_income")
    assert table.schema.names == schemas.SALARY_INCOME.names
    assert sorted(r["customer_id"] for r in table.collect()) == [1, 4]
    later = read_table(spark, config, "salary_income", since=SECOND)
    assert [r["customer_id"] for r in later.collect()] == [4]


def test_since_prunes_partitions(spark, config):
    put(salary(spark, FIRST, (1, 5.0)), config)
    plan = read_table(spark, config, "salary_income", since=SECOND)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(ingestion_date" in plan


def test_overwrite_drops_earlier_months_and_replace_keeps_them(spark, config):
    def write(df, mode):
        write_table(df, config, "score", mode=mode, partition_by=["score_month"])

    def months():
        return sorted(r["score_month"] for r in read_table(spark, config, "score").collect())

    write(scores(spark, "2024-03", 1), "overwrite")
    write(scores(spark, "2024-04", 1, 2), "replace_partition")
    write(scores(spark, "2024-04", 1), "replace_partition")
    assert months() == ["2024-03", "2024-04"]
    write(scores(spark, "2024-05", 1), "overwrite")
    assert months() == ["2024-05"]
    assert dict(read_table(spark, config, "score").dtypes)["score_month"] == "string"


def test_columns_that_a_later_load_adds(spark, config):
    put(salary(spark, FIRST, (1, 5.0)), config)
    put(salary(spark, SECOND, (2, 5.0)).withColumn("bonus", F.lit(1)), config)
    assert "bonus" not in read_table(spark, config, "salary_income").columns
    merged = read_table(spark, config, "salary_income", merge_schema=True)
    assert {r["customer_id"]: r["bonus"] for r in merged.collect()} == {1: None, 2: 1}


def test_overwrite_may_change_the_columns(spark, config):
    write_table(spark.range(1).selectExpr("'a' AS x"), config, "debit_transactions_silver", mode="overwrite")
    write_table(spark.range(1).selectExpr("1 AS year"), config, "debit_transactions_silver", mode="overwrite")
    table = read_table(spark, config, "debit_transactions_silver", merge_schema=True)
    assert table.columns == ["year"]


def test_audit_is_appended(spark, config):
    for _ in range(2):
        append_audit(scores(spark, "2024-04", 1), config)
    assert read_table(spark, config, "score_audit").count() == 2


def test_modes_are_checked(spark, config):
    with pytest.raises(ValueError):
        put(salary(spark, FIRST, (1, 5.0)), config, "ignore")
    with pytest.raises(ValueError):
        write_table(salary(spark, FIRST, (1, 5.0)), config, "salary_income", mode="replace_partition")
