from __future__ import annotations

import json
from datetime import date

import pytest

from spendscore.config import JdbcConfig, JdbcPartition, PipelineConfig, SourceSpec
from spendscore.operators import bronze
from spendscore.sources.readers import jdbc_options, read_files, read_jdbc, read_source
from spendscore.sources.workdir import stage, work_dir

JDBC = JdbcConfig("jdbc:postgresql://db/bank", user="reader", driver="org.postgresql.Driver")


def test_jdbc_options(monkeypatch):
    monkeypatch.setenv(JDBC.password_env, "secret")
    options = jdbc_options(JDBC, "transactions")
    assert options == {
        "url": "jdbc:postgresql://db/bank", "dbtable": "transactions", "user": "reader",
        "password": "secret", "driver": "org.postgresql.Driver", "fetchsize": "10000",
    }
    parts = jdbc_options(JDBC, "transactions", JdbcPartition("txn_date", "2020-01-01", "2024-01-01", 64))
    assert parts["numPartitions"] == "64" and parts["partitionColumn"] == "txn_date"
    monkeypatch.delenv(JDBC.password_env)
    assert "password" not in jdbc_options(JDBC, "transactions")


def test_settings_file(tmp_path):
    path = tmp_path / "settings.json"
    raw = {
        "root": "/data/spend",
        "jdbc": {"url": "jdbc:x", "user": "u"},
        "append_mode": "replace_partition",
        "sources": {
            "transactions": {
                "format": "jdbc", "location": "transactions",
                "partition": {"column": "id", "lower": "0", "upper": "9", "count": 3},
            },
            "subscriptions": {"format": "parquet", "location": "/in/subs"},
        },
    }
    path.write_text(json.dumps(raw))
    config = PipelineConfig.from_json(str(path))
    assert config.sources["transactions"].partition.count == 3
    assert config.append_mode == "replace_partition" and config.score_mode == "overwrite"
    assert config.table_path("salary_income") == "/data/spend/bronze/salary_income"
    raw["jdbc"]["password"] = "x"
    path.write_text(json.dumps(raw))
    with pytest.raises(ValueError, match="environment"):
        PipelineConfig.from_json(str(path))


def test_jdbc_source_needs_a_connection(spark, tmp_path):
    path = tmp_path / "settings.json"
    path.write_text(json.dumps(
        {"root": "/x", "sources": {"transactions": {"format": "jdbc", "location": "t"}}}
    ))
    with pytest.raises(ValueError, match="no connection"):
        read_source(spark, PipelineConfig.from_json(str(path)), "transactions")


def test_csv_with_inferred_declared_and_foreign_dates(spark, tmp_path):
    path = tmp_path / "statements.csv"
    path.write_text(
        "customer_id,statement_date,total_due,minimum_due,paid_amount\n"
        "1,2024-01-05,100.5,5.0,10.75\n2,2024-01-06,x,5.0,\n"
    )
    inferred = read_files(spark, str(path), "csv", inferSchema="true")
    assert dict(inferred.dtypes)["statement_date"] == "date"
    assert set(dict(read_files(spark, str(path), "csv").dtypes).values()) == {"string"}
    rows = bronze.conform_statements(inferred, date(2024, 4, 1)).collect()
    assert [(r["total_due"], r["paid_amount"]) for r in rows] == [(100.5, 10), (None, None)]
    text = ", ".join(f"{name} string" for name in inferred.columns)
    declared = bronze.conform_statements(
        read_files(spark, str(path), "csv", schema=text), date(2024, 4, 1)
    )
    assert declared.collect() == rows

    foreign = tmp_path / "foreign.csv"
    foreign.write_text("customer_id,statement_date,total_due,minimum_due,paid_amount\n1,31/01/2024,1,1,1\n")
    df = read_files(spark, str(foreign), "csv")
    assert dict(df.dtypes)["statement_date"] == "string"
    assert bronze.conform_statements(df).first()["statement_date"] is None


def test_stage_reads_back_the_same_rows(spark):
    df = spark.range(10).withColumnRenamed("id", "v")
    staged = stage(df, "test")
    assert sorted(r["v"] for r in staged.collect()) == list(range(10))
    assert work_dir(spark, "a") != work_dir(spark, "a")


def test_opening_a_declared_csv_runs_no_job(spark, tmp_path):
    path = tmp_path / "statements.csv"
    path.write_text("customer_id,statement_date,total_due,minimum_due,paid_amount\n1,2024-01-05,100.5,5.0,10.75\n")
    config = PipelineConfig("", {"credit_card_statements": SourceSpec("csv", str(path))})
    context = spark.sparkContext
    context.setJobGroup("open-csv", "")
    df = read_source(spark, config, "credit_card_statements")
    assert not context.statusTracker().getJobIdsForGroup("open-csv")
    context.setJobGroup("", "")
    assert set(dict(df.dtypes).values()) == {"string"}
    assert bronze.conform_statements(df).first()["paid_amount"] == 10
    path.write_text("customer_id,total_due,statement_date,minimum_due,paid_amount\n1,100.5,2024-01-05,5.0,10.75\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_source(spark, config, "credit_card_statements").collect()


def test_jdbc_ranges_or_predicates(spark):
    with pytest.raises(ValueError, match="not both"):
        read_jdbc(spark, JDBC, "t", JdbcPartition("id", "0", "9", 3), predicates=["a = 1"])
    config = PipelineConfig("", {"transactions": SourceSpec("jdbc", "t")}, JdbcConfig("jdbc:none:x"))
    with pytest.warns(UserWarning, match="one task"), pytest.raises(Exception):
        read_source(spark, config, "transactions")
