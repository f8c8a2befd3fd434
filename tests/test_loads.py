from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendscore.config import PipelineConfig, SourceSpec
from spendscore.operators import gold, reports, silver
from spendscore.operators import quantiles as quantile_module
from spendscore.plans import increments, pipeline
from spendscore.sources import fixtures, folders, ledger
from spendscore.sources.batches import committed_batch, compact, read_batches, snapshots
from spendscore.sources.tables import read_table, write_table
from spendscore.sources.widening import read_widened, wider, widened, write_load
from spendscore.streaming import late, streams

SF = "/root/testdata/sf0.001"
DAY = date(2024, 4, 1)


@pytest.fixture
def config(tmp_path):
    return PipelineConfig(str(tmp_path))


def differ(left, right):
    return left.exceptAll(right).count() + right.exceptAll(left).count()


# --- repeated runs ------------------------------------------------------------


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    specs = {}
    for name in ("salary_income", "transactions", "subscriptions", "credit_card_statements"):
        specs[name] = SourceSpec("parquet", str(root / name))
        getattr(fixtures, name)(spark, SF).write.parquet(specs[name].location)
    return specs


def stored(spark, config):
    return {name: read_table(spark, config, name).count() for name in (
        "salary_income", "transactions", "debit_transactions", "subscriptions", "credit_card_statements")}


def test_a_run_that_failed_goes_on(spark, sources, tmp_path):
    config = PipelineConfig(str(tmp_path / "once"), sources)
    pipeline.run_bronze(spark, config, DAY)
    expected = stored(spark, config)
    config = PipelineConfig(str(tmp_path / "again"), sources)

    def fail(name):
        if name == "transactions":
            raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        pipeline.run_bronze(spark, config, DAY, run="r1", on_stored=fail)
    assert not [name for name in folders.names(spark, f"{tmp_path}/again/staging") if name.startswith("transactions-")]
    pipeline.run_bronze(spark, config, DAY, run="r1")
    assert stored(spark, config) == expected
    pipeline.run_bronze(spark, config, DAY, run="r1")
    assert stored(spark, config) == expected
    pipeline.run_bronze(spark, config, DAY, run="r2")  # another load of the same day is added
    assert stored(spark, config) == {name: 2 * n for name, n in expected.items()}


def test_a_run_stopped_while_files_are_renamed_goes_on(spark, config, monkeypatch):
    df = spark.range(0, 40, 1, 8).selectExpr("cast(id AS int) AS customer_id", "cast(id AS double) AS salary_amount",
                                             "date'2024-03-31' AS pay_date", "date'2024-04-01' AS ingestion_date")
    rename, done = folders.rename, []

    def stop(spark, source, target):
        if len(done) == 3:
            raise OSError("stopped")
        done.append(target)
        rename(spark, source, target)

    monkeypatch.setattr(folders, "rename", stop)
    put = lambda: ledger.store_once(df, config, "salary_income", run="r", partition_by=["ingestion_date"])
    with pytest.raises(OSError):
        put()
    monkeypatch.setattr(folders, "rename", rename)
    assert put() is True and put() is False
    table = read_table(spark, config, "salary_income")
    assert sorted(r["customer_id"] for r in table.collect()) == list(range(40))
    with pytest.raises(ValueError):
        ledger.store_once(df, config, "salary_income", run="../r", partition_by=[])


def test_whole_job_as_a_named_run(spark, sources, tmp_path):
    config = PipelineConfig(str(tmp_path), sources)
    for _ in range(2):
        frames = pipeline.run_pipeline(spark, config, DAY, at=datetime(2024, 4, 1, 6), run="day-1")
        spend = {r["customer_id"]: r["total_spend"] for r in frames["score"].collect()}
        assert frames["score_audit"].count() == len(spend)
    assert folders.names(spark, f"{tmp_path}/staging") == []


# --- types that change ----------------------------------------------------------


@pytest.mark.parametrize("left, right, both", [
    ("int", "bigint", "bigint"), ("bigint", "int", "bigint"), ("int", "double", "double"), ("smallint", "float", "float"),
    ("int", "float", "double"), ("date", "timestamp", "timestamp"), ("string", "int", "string"), ("boolean", "int", "string"),
    ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"), ("decimal(10,2)", "int", "double"), ("void", "int", "int"), ("int", "int", "int"),
])
def test_wider_types(left, right, both):
    kind = T._parse_datatype_string
    assert wider(kind(left), kind(right)) == kind(both)
    if "void" not in (left, right):
        assert wider(kind(right), kind(left)) == kind(both)


def test_loads_of_different_types(spark, config):
    loads = {
        "2024-04-01": ("id int, amount int, note string", [(1, 5, "a"), (None, None, None)]),
        "2024-04-02": ("id bigint, amount double", [(3_000_000_000, 0.5)]),
        "2024-04-03": ("id int, amount int, note string", [(7, 8, "b")]),
        "2024-04-04": ("id string, amount int, more date", [("x7", 1, date(2024, 1, 1))]),
    }
    for day, (schema, rows) in loads.items():
        write_load(spark.createDataFrame(rows, schema).withColumn("d", F.lit(day)), config, "salary_income", load=day, by="d")
    table = read_widened(spark, config, "salary_income", by="d")
    assert table.schema.simpleString() == "struct<id:string,amount:double,note:string,more:date,d:date>"
    assert sorted(((str(r["d"])[-1], r["id"], r["amount"], r["note"], r["more"]) for r in table.collect()), key=repr) == sorted([
        ("1", "1", 5.0, "a", None), ("1", None, None, None, None), ("2", "3000000000", 0.5, None, None), ("3", "7", 8.0, "b", None),
        ("4", "x7", 1.0, None, date(2024, 1, 1))], key=repr)
    pruned = table.filter(F.col("d") == F.lit("2024-04-02").cast("date"))
    assert pruned.count() == 1 and "PartitionFilters: [isnotnull(d" in pruned._jdf.queryExecution().executedPlan().toString()
    # a load replaced by one of other types
    write_load(spark.createDataFrame([(9, 9)], "id int, amount int").withColumn("d", F.lit("x")), config, "salary_income",
               load="2024-04-04", by="d", mode="overwrite")
    assert read_widened(spark, config, "salary_income", by="d").schema["id"].dataType == T.LongType()
    with pytest.raises(ValueError, match="other types"):
        write_load(spark.createDataFrame([("q",)], "id string").withColumn("d", F.lit("x")), config, "salary_income", load="2024-04-04", by="d")
    with pytest.raises(ValueError, match="no type holds"):
        widened([T.StructType().add("a", "string"), T.StructType().add("a", T.ArrayType(T.StringType()))])


# --- features by load --------------------------------------------------------------


def debits(spark, rows):
    return spark.createDataFrame(rows, "customer_id int, txn_date date, amount double, merchant string, category string, ingestion_date date").selectExpr(
        "*", "'debit' AS txn_type", "'pos' AS channel", "5000 AS mcc_code")


def test_features_load_by_load(spark, config):
    rng = random.Random(3)
    days = [date(2024, 4, d) for d in (1, 2, 3)]
    rows = [(rng.choice([None, 1, 2, 3]), rng.choice([None, date(2024, 1, rng.randint(1, 5))]), rng.choice([None, 0.5, 3.25, 10.0]), "m",
             rng.choice(["Rent", "Utilities", "Other"]), rng.choice(days)) for _ in range(400)]
    salary = spark.createDataFrame([(1, 900.0), (2, None)], "customer_id int, salary_amount double")
    put = lambda kept: write_table(silver.with_year_month(debits(spark, kept)), config, "debit_transactions_silver", mode="replace_partition",
                                   partition_by=["ingestion_date"])
    tidy = lambda df: sorted((tuple(x if not isinstance(x, float) else round(x, 6) for x in r) for r in df.collect()), key=repr)
    for k, day in enumerate(days):
        put([r for r in rows if r[5] == day])
        increments.update_features(spark, config, day)
        known = debits(spark, [r for r in rows if r[5] in days[: k + 1]])
        assert tidy(increments.summary_from_state(spark, config, salary)) == tidy(gold.gold_summary(known, salary))
    # the first load is corrected, and comes again
    rows = [(*r[:2], None if r[2] is None else r[2] + 1, *r[3:]) if r[5] == days[0] else r for r in rows]
    for _ in range(2):
        put([r for r in rows if r[5] == days[0]])
        increments.update_features(spark, config, days[0])
    assert tidy(increments.summary_from_state(spark, config, salary)) == tidy(gold.gold_summary(debits(spark, rows), salary))
    plan = increments.load_state(read_table(spark, config, "debit_transactions_silver"), days[2])
    assert "PartitionFilters: [isnotnull(ingestion_date" in plan._jdf.queryExecution().executedPlan().toString()
    assert {f.split("=")[1].split("/")[0] for f in plan.inputFiles() if "=" in f} >= {"2024-04-03"}
    # a load that is gone
    folders.remove(spark, f"{config.table_path('debit_transactions_silver')}/ingestion_date=2024-04-02")
    increments.update_features(spark, config, days[1])
    left = debits(spark, [r for r in rows if r[5] != days[1]])
    assert tidy(increments.summary_from_state(spark, config, salary)) == tidy(gold.gold_summary(left, salary))


# --- selection of ranks --------------------------------------------------------------


@pytest.mark.parametrize("max_rows", [10, 1])
def test_ranges_are_narrowed_to_the_bound(spark, monkeypatch, max_rows):
    rng = random.Random(9)
    values = {1: [rng.gauss(0, 5) for _ in range(4000)], 2: [7.0] * 1500 + [rng.random() for _ in range(900)] + [rng.random() + 8 for _ in range(700)],
              3: [1.0, 2.0] * 600, 4: [float(rng.randint(1, 12)) for _ in range(2000)], None: [3.0, 4.0], 6: [float("nan")] * 30 + [1.0, 2.0]}
    df = spark.createDataFrame([(g, v) for g, vs in values.items() for v in vs], "g int, v double")
    seen = []
    counted = quantile_module._counted

    def watched(rows, ranges, group, value):
        seen.extend(ranges.collect())
        return counted(rows, ranges, group, value)

    monkeypatch.setattr(quantile_module, "_counted", watched)
    got = {r["g"]: r for r in quantile_module.grouped_quantiles(df, "g", "v", {"q1": 0.25, "median": 0.5, "q3": 0.75}, accuracy=50, margin=0.05, max_rows=max_rows).collect()}
    import numpy as np
    for g, vs in values.items():
        if g != 6:
            assert [got[g][n] for n in ("q1", "median", "q3")] == pytest.approx(list(np.quantile(vs, [0.25, 0.5, 0.75])), rel=1e-12)
    assert got[6]["n"] == 32 and got[6]["median"] != got[6]["median"]
    assert seen and all(r["_size"] <= max_rows or not r["_least"] < r["_most"] for r in seen)


def test_box_plot_with_small_ranges(spark):
    score = pipeline_score(spark)
    left, right = reports.spend_boxstats(score), reports.spend_boxstats(score, max_rows=5)
    assert differ(left, right) == 0 and left.count() > 3


def pipeline_score(spark):
    rng = random.Random(5)
    return spark.createDataFrame([(k, round(rng.random() * 1000, 2), rng.randint(300, 304)) for k in range(3000)],
                                 "customer_id int, total_spend double, sds_score int")


# --- streams ------------------------------------------------------------------------


def parts_of(spark, path, rows, schema):
    """One file per list of rows, in order of time."""
    import os
    for k, part in enumerate(rows):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{path}/{k:03d}")
        for name in os.listdir(f"{path}/{k:03d}"):
            os.utime(f"{path}/{k:03d}/{name}", (1_700_000_000 + k, 1_700_000_000 + k))
    return streams.stream_files(spark, f"{path}/*", spark.createDataFrame([], schema).schema, maxFilesPerTrigger="1")


EVENT = "customer_id int, ts timestamp_ntz, amount double"


def test_late_rows_are_kept(spark, config, tmp_path):
    at = lambda day, hour=12: datetime(2024, 1, day, hour)
    batches = [
        [(1, at(1), 1.0), (2, at(1), 2.0)],
        [(1, at(5), 4.0), (None, at(4), 8.0)],  # closes day 1
        [(1, at(1), 16.0), (3, at(1), 32.0), (1, at(4), 64.0), (1, None, 999.0)],  # day 1 is late, day 4 isn't
        [(1, at(9), 128.0)],
    ]
    events = parts_of(spark, str(tmp_path / "in"), batches, EVENT)
    late.stream_daily_spend_kept(events, config, str(tmp_path / "log")).awaitTermination()
    rows = lambda df: sorted(map(repr, (tuple(r) for r in df.collect())))
    assert rows(read_batches(spark, config, late.LATE).filter("ts IS NOT NULL").select("customer_id", "amount")) == ["(1, 16.0)", "(3, 32.0)"]
    assert rows(late.corrected_daily_spend(spark, config)) == sorted(map(repr, [
        (1, date(2024, 1, 1), 17.0, 1), (2, date(2024, 1, 1), 2.0, 0), (3, date(2024, 1, 1), 32.0, 1), (None, date(2024, 1, 4), 8.0, 0),
        (1, date(2024, 1, 4), 64.0, 0), (1, date(2024, 1, 5), 4.0, 0)]))
    assert late.corrected_daily_spend(spark, config, with_open=True).count() == 7
    # a batch that is repeated replaces what it wrote
    before = rows(late.corrected_daily_spend(spark, config, with_open=True))
    late.store_batch(spark.createDataFrame(batches[3], EVENT), 3, config, timedelta(days=2))
    assert rows(late.corrected_daily_spend(spark, config, with_open=True)) == before
    assert len(folders.numbered(spark, config.table_path(late.OPEN), "batch")) <= 3


def test_stream_and_correction_equal_the_batch_sums(spark, config, tmp_path):
    rng = random.Random(11)
    batches = [[(rng.randint(1, 4), datetime(2024, 1, rng.randint(1, 25), rng.randint(0, 23)), float(rng.randint(1, 99))) for _ in range(40)] for _ in range(5)]
    events = parts_of(spark, str(tmp_path / "in"), batches, EVENT)
    late.stream_daily_spend_kept(events, config, str(tmp_path / "log")).awaitTermination()
    whole = spark.createDataFrame([r for part in batches for r in part], EVENT).groupBy("customer_id", F.to_date("ts").alias("txn_date")).agg(
        F.sum("amount").alias("daily_spend"))
    got = late.corrected_daily_spend(spark, config, with_open=True)
    assert differ(got.drop("late_rows"), whole) == 0
    assert got.agg(F.sum("late_rows")).first()[0] > 20


def test_folded_batches(spark, config, tmp_path):
    batches = [[(k % 3, datetime(2024, 1, 1 + k), float(k))] for k in range(12)]
    log, name = str(tmp_path / "log"), "daily_spend_stream"
    events = parts_of(spark, str(tmp_path / "in"), batches[:8], EVENT)
    run = lambda: streams.stream_to_table(events, config, name, log).awaitTermination()
    run()
    tidy = lambda: sorted((r["batch"], r["customer_id"], r["amount"]) for r in read_batches(spark, config, name).collect())
    expected = [(k, k % 3, float(k)) for k in range(8)]
    assert tidy() == expected and committed_batch(spark, log) == 7
    assert compact(spark, config, name, log) == 7 and tidy() == expected
    assert compact(spark, config, name, log) == 7 and tidy() == expected  # removes what the first one replaced
    assert folders.numbered(spark, config.table_path(name), "batch") == [] and snapshots(spark, config, name) == [7]
    # a folded batch that is repeated changes nothing
    streams.write_table(spark.createDataFrame([(1, datetime(2024, 1, 4), 3.0, 3)], EVENT + ", batch long"), config, name, mode="replace_partition", partition_by=["batch"])
    assert tidy() == expected
    # a fold that broke off before its end isn't read
    spark.createDataFrame([(9, datetime(2024, 1, 4), 3.0, 3)], EVENT + ", batch long").write.parquet(f"{config.table_path(name)}_folded/upto=9")
    folders.remove(spark, f"{config.table_path(name)}_folded/upto=9/_SUCCESS")
    assert tidy() == expected


def test_folding_keeps_the_newest_row_of_a_key(spark, config, tmp_path):
    batches = [[(1, datetime(2024, 1, 1, k), float(k)), (2, datetime(2024, 1, 1 + k), 1.0)] for k in range(6)]
    log, name = str(tmp_path / "log"), "daily_spend_stream"
    stream = streams.stream_daily_spend(parts_of(spark, str(tmp_path / "in"), batches, EVENT), "30 days")
    streams.stream_to_table(stream, config, name, log, output_mode="update").awaitTermination()
    keys = ["customer_id", "txn_date"]
    expected = sorted(map(tuple, streams.latest_rows(read_batches(spark, config, name), keys).collect()))
    compact(spark, config, name, log, keys=keys)
    folded = read_batches(spark, config, name)
    assert folded.count() == len(expected) == 7
    assert sorted(map(tuple, streams.latest_rows(folded, keys).collect())) == expected


def test_folded_debits_are_read_by_the_next_layer(spark, config, tmp_path):
    """Bronze written by a stream in batches, by load date too: read the same before and after it is folded, and pruned."""
    raw = fixtures.transactions(spark, SF)
    for k in range(4):
        raw.filter(F.col("mcc_code") % 4 == k).coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
    stream = streams.stream_debit(streams.stream_files(spark, f"{tmp_path}/in/*", raw.schema, maxFilesPerTrigger="1"), DAY)
    name, log = "debit_transactions_stream", str(tmp_path / "log")
    streams.stream_to_table(stream, config, name, log, partition_by=["ingestion_date"]).awaitTermination()
    before = read_table(spark, config, name).collect()
    for _ in range(2):
        compact(spark, config, name, log, partition_by=["ingestion_date"])
        assert sorted(map(repr, read_table(spark, config, name).collect())) == sorted(map(repr, before))
    assert folders.numbered(spark, config.table_path(name), "batch") == []
    since = read_table(spark, config, name, since=date(2024, 4, 2))
    assert since.count() == 0 and "PartitionFilters: [isnotnull(ingestion_date" in since._jdf.queryExecution().executedPlan().toString()
    stored = pipeline.run_silver(spark, config, debit_tables=[name])["debit_transactions_silver"]
    assert stored.count() == len(before)


def test_session_settings(spark):
    session = pipeline.get_session("x", **{"spark.sql.shuffle.partitions": "8"})
    assert session.range(3).count() == 3 and session.conf.get("spark.sql.shuffle.partitions") == "8"
