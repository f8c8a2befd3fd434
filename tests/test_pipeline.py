from __future__ import annotations

import json
import re
import sys
from collections import Counter
from dataclasses import replace
from datetime import date, datetime

import pytest

from spendscore import __main__ as command_line
from spendscore import schemas
from spendscore.config import PipelineConfig, SourceSpec
from spendscore.plans import pipeline
from spendscore.sources import fixtures
from spendscore.sources.tables import read_table

SF = "/root/testdata/sf0.001"
DAY, NEXT_MONTH = date(2024, 4, 1), date(2024, 5, 1)


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    specs = {}
    for name in ("salary_income", "transactions", "subscriptions", "credit_card_statements"):
        fmt = "csv" if name == "credit_card_statements" else "parquet"
        specs[name] = SourceSpec(fmt, str(root / name))
        writer = getattr(fixtures, name)(spark, SF).write.format(fmt)
        (writer.option("header", True) if fmt == "csv" else writer).save(specs[name].location)
    return specs


def test_run_twice(spark, sources, tmp_path, capsys):
    config = PipelineConfig(str(tmp_path), sources)
    frames = pipeline.run_pipeline(spark, config, DAY, at=datetime(2024, 4, 1, 6), preview=True)
    assert "recurring_merchants" in capsys.readouterr().out
    for name, schema in schemas.STORED.items():
        if name == "debit_transactions_stream":
            continue
        stored = read_table(spark, config, name)
        assert [(f.name, f.dataType) for f in stored.schema] == [(f.name, f.dataType) for f in schema]
        assert stored.count() > 0, name
    score, audit = frames["score"], frames["score_audit"]
    assert audit.select(*score.columns).exceptAll(score).count() == 0
    assert audit.count() == score.count()
    assert sum(r["customers"] for r in frames["score_histogram"].collect()) == score.count()
    spend = {r["customer_id"]: r["total_spend"] for r in score.collect()}

    # appending the same day again doubles every sum, as a retry would
    again = pipeline.run_pipeline(spark, config, DAY)
    doubled = {r["customer_id"]: r["total_spend"] for r in again["score"].collect()}
    assert doubled == pytest.approx({customer: 2 * total for customer, total in spend.items()})


def test_replacing_partitions_makes_a_rerun_harmless(spark, sources, tmp_path):
    config = replace(
        PipelineConfig(str(tmp_path), sources),
        append_mode="replace_partition", score_mode="replace_partition",
    )
    first = pipeline.run_pipeline(spark, config, DAY)["score"].collect()
    second = pipeline.run_pipeline(spark, config, DAY)["score"].collect()
    assert Counter(first) == Counter(second)
    pipeline.run_gold(spark, config, NEXT_MONTH)
    months = {r["score_month"] for r in read_table(spark, config, "score").collect()}
    assert months == {"2024-04", "2024-05"}
    customers = len(second)
    for day in (None, DAY, NEXT_MONTH):
        frames = pipeline.run_reports(spark, config, day)
        assert len(frames) == 9 and sum(r["customers"] for r in frames["score_histogram"].collect()) == customers
        assert frames["scatter_points"].count() == customers
        assert sum(r["n"] for r in frames["spend_boxstats"].collect()) == customers
        top = [r["customer_id"] for r in frames["top_spenders"].collect()]
        assert len(set(top)) == len(top) == 5


def test_whole_job_by_command_line(spark, sources, tmp_path, monkeypatch, capsys):
    settings = {
        "root": str(tmp_path / "tables"),
        "sources": {name: {"format": spec.format, "location": spec.location} for name, spec in sources.items()},
    }
    path = tmp_path / "settings.json"
    path.write_text(json.dumps(settings))
    monkeypatch.setattr(sys, "argv", ["spendscore", str(path), "--as-of", "2024-04-01", "--months", "1995-01:1995-03", "--preview"])
    command_line.main()
    shown = capsys.readouterr().out
    for name in ("score_histogram", "correlations", "pivot_months"):
        assert list((tmp_path / "tables").glob(f"*/{name}/*.parquet")) and name in shown
    stored = {p.parent.name for p in (tmp_path / "tables").glob("*/*/_SUCCESS")}
    assert len(stored) == 8 + 9 + 1 and not list((tmp_path / "tables" / "staging").iterdir())


def test_second_day_rewrites_that_day_of_silver(spark, sources, tmp_path):
    config = replace(PipelineConfig(str(tmp_path), sources), append_mode="replace_partition")
    for day in (DAY, NEXT_MONTH):
        pipeline.run_bronze(spark, config, day)
        pipeline.run_silver(spark, config, since=day)
    first = tmp_path / "silver/debit_transactions_silver"
    before = {p.name for p in (first / "ingestion_date=2024-04-01").iterdir()}
    pipeline.run_silver(spark, config, since=NEXT_MONTH)
    assert {p.name for p in (first / "ingestion_date=2024-04-01").iterdir()} == before
    silver = read_table(spark, config, "debit_transactions_silver")
    assert {str(r[0]) for r in silver.select("ingestion_date").distinct().collect()} == {"2024-04-01", "2024-05-01"}


def test_silver_since_reads_later_loads_only(spark, sources, tmp_path):
    config = PipelineConfig(str(tmp_path), sources)
    pipeline.run_bronze(spark, config, DAY)
    pipeline.run_bronze(spark, config, NEXT_MONTH)
    both = pipeline.run_silver(spark, config)["debit_transactions_silver"].count()
    later = pipeline.run_silver(spark, config, since=NEXT_MONTH, months=["1995_Jan"])
    assert later["debit_transactions_silver"].count() * 2 == both
    assert later["pivot_months"].columns == ["customer_id", "1995_Jan"]


def test_transactions_are_written_without_a_sort_by_date(spark, sources, tmp_path, monkeypatch):
    """They lie on disk with their date; as a constant it needs no sort to be written by partitions."""
    plans = {}

    def write(df, config, name, **options):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        write_table(df, config, name, **options)

    write_table = pipeline.write_table
    monkeypatch.setattr(pipeline, "write_table", write)
    frames = pipeline.run_bronze(spark, PipelineConfig(str(tmp_path), sources), DAY)
    for name in ("transactions", "debit_transactions"):
        assert re.search(r"AS ingestion_date#", plans[name].splitlines()[0]), plans[name]
        assert [r[0] for r in frames[name].select("ingestion_date").distinct().collect()] == [DAY]
