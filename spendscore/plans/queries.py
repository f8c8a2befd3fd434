"""The registered queries: each operator on the mapped test tables.

Values are rounded here, not in the operators: sums of doubles differ in
their last bits with the order in which they are added.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendscore.config import PipelineConfig, SourceSpec
from spendscore.operators import bronze, examples, gold, reports, rules, silver, text, windows
from spendscore.plans import increments, pipeline
from spendscore.sources import fixtures
from spendscore.sources.readers import read_source
from spendscore.sources.tables import append_audit, read_table, write_table
from spendscore.sources.widening import read_widened, write_load
from spendscore.sources.workdir import stage, work_dir
from spendscore.streaming import late, streams
from spendscore.sources.batches import committed_batch, compact, read_batches

# The run's date and time, given so that stamps can be compared.
AS_OF, NEXT_DAY = date(2024, 4, 1), date(2024, 4, 2)
AT, LATER = datetime(2024, 4, 1, 6, 30), datetime(2024, 4, 1, 18, 0)

# All months the orders span.
FIRST_MONTH, LAST_MONTH = date(1995, 1, 1), date(2001, 8, 1)
MONTHS = silver.month_labels(FIRST_MONTH, LAST_MONTH)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _round(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, digits) for name in names})


def _transactions_of(raw):
    return bronze.conform_transactions(raw, AS_OF)


def _transactions(spark, sf_dir):
    return _transactions_of(fixtures.transactions(spark, sf_dir))


def _debit(spark, sf_dir):
    return bronze.debit_transactions(_transactions(spark, sf_dir))


def _salary(spark, sf_dir):
    return bronze.conform_salary(fixtures.salary_income(spark, sf_dir), AS_OF)


def _score(spark, sf_dir):
    return gold.gold_score(_debit(spark, sf_dir), _salary(spark, sf_dir), AS_OF)


def _cent_score(spark, sf_dir):
    """Scores with the spend in whole cents, the same however it is summed."""
    return _round(_score(spark, sf_dir), 2, "total_spend")


# --- sources and bronze ---------------------------------------------------


@_query
def scan_subscriptions(spark, sf_dir):
    return fixtures.subscriptions(spark, sf_dir)


@_query
def bronze_salary(spark, sf_dir):
    return _round(_salary(spark, sf_dir), 2, "salary_amount")


@_query
def bronze_transactions(spark, sf_dir):
    return _transactions(spark, sf_dir)


@_query
def bronze_subscriptions(spark, sf_dir):
    return bronze.conform_subscriptions(fixtures.subscriptions(spark, sf_dir), AS_OF)


@_query
def bronze_statements(spark, sf_dir):
    return bronze.conform_statements(fixtures.credit_card_statements(spark, sf_dir), AS_OF)


@_query
def bronze_statements_csv(spark, sf_dir):
    """The statements by way of CSV files with a header, read as text of the declared columns."""
    path = work_dir(spark, "statements-csv")
    fixtures.credit_card_statements(spark, sf_dir).write.csv(path, header=True)
    config = PipelineConfig("", {"credit_card_statements": SourceSpec("csv", path)})
    return bronze.conform_statements(read_source(spark, config, "credit_card_statements"), AS_OF)


@_query
def bronze_transactions_text(spark, sf_dir):
    """Transactions delivered as text, with fractions and bad amounts in it."""
    raw = fixtures.transactions(spark, sf_dir)
    text_only = raw.select([F.col(name).cast("string").alias(name) for name in raw.columns])
    return _transactions_of(
        text_only.withColumns(
            {
                "customer_id": F.concat(F.lit(" "), "customer_id", F.lit(" ")),
                "mcc_code": F.concat("mcc_code", F.lit(".75")),
                "amount": F.when(F.col("txn_type") == "Credit", "n/a").otherwise(F.col("amount")),
            }
        )
    )


@_query
def debit_only(spark, sf_dir):
    return bronze.debit_only(_transactions(spark, sf_dir))


@_query
def categorize(spark, sf_dir):
    return _debit(spark, sf_dir)


@_query
def categorize_rules(spark, sf_dir):
    """The default rules as a table, matched by an index of their rarest runs."""
    return rules.categorize_by_rules(bronze.debit_only(_transactions(spark, sf_dir)), rules.rules_table(spark))


# --- silver -----------------------------------------------------------------


@_query
def silver_rows(spark, sf_dir):
    return silver.with_year_month(_debit(spark, sf_dir))


@_query
def daily_spend(spark, sf_dir):
    return _round(silver.daily_spend(_debit(spark, sf_dir)), 2, "daily_spend")


@_query
def volatility(spark, sf_dir):
    return _round(silver.volatility(_debit(spark, sf_dir)), 6, "spend_volatility")


@_query
def recurring_merchants(spark, sf_dir):
    return silver.recurring_merchants(_debit(spark, sf_dir))


@_query
def total_spend_window(spark, sf_dir):
    rows = windows.with_total_spend(_debit(spark, sf_dir))
    return _round(rows, 2, "total_spend")


@_query
def total_spend_window_heavy(spark, sf_dir):
    """The same where every customer that fits the broadcast counts as heavy."""
    rows = windows.with_total_spend(_debit(spark, sf_dir), hot_rows=0)
    return _round(rows, 2, "total_spend")


def _rolling_columns(rows):
    """Rows of equal date and amount share out their sums in any order."""
    return _round(
        rows.select("customer_id", "category", "txn_date", "amount", "three_month_category_spend"),
        2,
        "three_month_category_spend",
    )


@_query
def rolling_3_rows(spark, sf_dir):
    return _rolling_columns(windows.rolling_rows(_debit(spark, sf_dir), 3))


@_query
def rolling_3_rows_heavy(spark, sf_dir):
    """The same where every group that fits the broadcast counts as heavy."""
    return _rolling_columns(windows.rolling_rows(_debit(spark, sf_dir), 3, hot_rows=0))


def _window_columns(rows):
    """Rows of equal date and amount share out their rolling sums in any order."""
    return _round(
        rows.select("customer_id", "category", "txn_date", "amount", "three_month_category_spend", "total_spend"),
        2,
        "three_month_category_spend",
        "total_spend",
    )


@_query
def spend_windows(spark, sf_dir):
    """Rolling sums and totals over one shuffle of the rows."""
    return _window_columns(windows.spend_windows(_debit(spark, sf_dir)))


@_query
def spend_windows_heavy(spark, sf_dir):
    """The same where every customer that fits the broadcast counts as heavy."""
    return _window_columns(windows.spend_windows(_debit(spark, sf_dir), hot_rows=0))


@_query
def rolling_3_months(spark, sf_dir):
    rows = windows.rolling_months(_debit(spark, sf_dir), 3)
    return _round(rows, 2, "monthly_spend", "rolling_spend")


@_query
def monthly_spend(spark, sf_dir):
    return _round(silver.monthly_spend(_debit(spark, sf_dir)), 2, "monthly_spend")


@_query
def pivot_months_sum(spark, sf_dir):
    monthly = silver.monthly_spend(_debit(spark, sf_dir))
    return _round(silver.pivot_months(monthly, MONTHS, agg="sum"), 2, *MONTHS)


@_query
def pivot_months_first(spark, sf_dir):
    monthly = silver.monthly_spend(_debit(spark, sf_dir))
    return _round(silver.pivot_months(monthly, MONTHS, agg="first"), 2, *MONTHS)


@_query
def spend_profile(spark, sf_dir):
    profile = silver.spend_profile(_debit(spark, sf_dir))
    return _round(_round(profile, 2, "total_spend"), 6, "spend_volatility")


@_query
def profile_fanout_size(spark, sf_dir):
    size = silver.profile_fanout_size(_debit(spark, sf_dir))
    return size.withColumn("joined_rows", F.col("joined_rows").cast("string"))


# --- stored tables ----------------------------------------------------------


def _salary_of(spark, sf_dir, day):
    return bronze.conform_salary(fixtures.salary_income(spark, sf_dir), day)


def _store_salary(config, df, mode="append"):
    write_table(df, config, "salary_income", mode=mode, partition_by=["ingestion_date"])


@_query
def table_append(spark, sf_dir):
    """A load that is repeated on the same day is in the table twice."""
    config = PipelineConfig(work_dir(spark, "append"))
    for _ in range(2):
        _store_salary(config, _salary_of(spark, sf_dir, AS_OF))
    return _round(read_table(spark, config, "salary_income"), 2, "salary_amount")


@_query
def table_replace_partition(spark, sf_dir):
    """Two days are loaded, the second one twice; each is there once."""
    config = PipelineConfig(work_dir(spark, "replace"))
    for day in (AS_OF, NEXT_DAY, NEXT_DAY):
        _store_salary(config, _salary_of(spark, sf_dir, day), "replace_partition")
    return _round(read_table(spark, config, "salary_income"), 2, "salary_amount")


@_query
def table_since(spark, sf_dir):
    """Of two loaded days, the rows since the second."""
    config = PipelineConfig(work_dir(spark, "since"))
    for day in (AS_OF, NEXT_DAY):
        _store_salary(config, _salary_of(spark, sf_dir, day))
    return _round(
        read_table(spark, config, "salary_income", since=NEXT_DAY), 2, "salary_amount"
    )


@_query
def table_merge_schema(spark, sf_dir):
    """The second load brings a column that the first one lacks."""
    config = PipelineConfig(work_dir(spark, "merge"))
    _store_salary(config, _salary_of(spark, sf_dir, AS_OF))
    second = _salary_of(spark, sf_dir, NEXT_DAY)
    _store_salary(config, second.withColumn("pay_year", F.year("pay_date")))
    table = read_table(spark, config, "salary_income", merge_schema=True)
    return _round(table, 2, "salary_amount")


@_query
def table_overwrite(spark, sf_dir):
    """A second month's scores take the place of the first month's."""
    config = PipelineConfig(work_dir(spark, "overwrite"))
    summary = stage(gold.gold_summary(_debit(spark, sf_dir), _salary(spark, sf_dir)), "summary")
    for day in (date(2024, 3, 1), AS_OF):
        scored = gold.score_customers(summary, day)
        write_table(scored, config, "score", mode="overwrite", partition_by=["score_month"])
    return _rounded_score(read_table(spark, config, "score"))


@_query
def table_widen_schema(spark, sf_dir):
    """A load of whole numbers, then one whose ids are beyond the int range and whose amounts have cents."""
    config = PipelineConfig(work_dir(spark, "widen"))
    customers = fixtures._read(spark, sf_dir, "customer")
    small = customers.select(F.col("c_custkey").cast("int").alias("customer_id"), F.floor("c_acctbal").cast("int").alias("amount"))
    large = customers.select((F.col("c_custkey") + 3_000_000_000).alias("customer_id"), F.col("c_acctbal").cast("double").alias("amount"), "c_mktsegment")
    for day, load in ((AS_OF, small), (NEXT_DAY, large)):
        write_load(load.withColumn("ingestion_date", F.lit(day)), config, "salary_income", load=day.isoformat(), by="ingestion_date")
    return read_widened(spark, config, "salary_income", by="ingestion_date")


# --- gold -------------------------------------------------------------------


@_query
def typed_debit(spark, sf_dir):
    """Debits whose dates and amounts arrive as text; amounts below 100 are no numbers."""
    rows = _debit(spark, sf_dir).select("customer_id", "txn_date", "amount", "category")
    as_text = {
        "txn_date": F.col("txn_date").cast("string"),
        "amount": F.when(F.col("amount") < 100, "n/a").otherwise(F.col("amount").cast("string")),
    }
    return gold.typed_debit(rows.withColumns(as_text))


@_query
def avg_salary(spark, sf_dir):
    return _round(gold.avg_salary(_salary(spark, sf_dir)), 6, "avg_salary")


@_query
def debit_features(spark, sf_dir):
    features = gold.debit_features(_debit(spark, sf_dir))
    return _round(features, 2, "total_spend", *gold.FEATURE_LABELS)


def _rounded_summary(summary):
    summary = _round(summary, 2, "total_spend", *gold.FEATURE_LABELS)
    summary = _round(summary, 4, "volatility_index")
    return _round(
        summary, 6, "avg_salary", "discretionary_ratio", "fixed_commitment_ratio",
        "salary_to_spend_ratio", "recurring_spend_ratio",
    )


def _rounded_score(score):
    score = _round(_round(score, 2, "total_spend"), 4, "volatility_index")
    return _round(
        score, 6, "discretionary_ratio", "fixed_commitment_ratio", "salary_to_spend_ratio",
        "recurring_spend_ratio",
    )


@_query
def gold_summary(spark, sf_dir):
    return _rounded_summary(gold.gold_summary(_debit(spark, sf_dir), _salary(spark, sf_dir)))


@_query
def features_incremental(spark, sf_dir):
    """Three loads one after another, each added to the stored state; the summary out of the state."""
    config = PipelineConfig(work_dir(spark, "increments"))
    debit = stage(silver.with_year_month(_debit(spark, sf_dir)), "debit")
    for k, day in enumerate((date(2024, 3, 31), AS_OF, NEXT_DAY)):
        load = debit.filter(F.col("mcc_code") % 3 == k).withColumn("ingestion_date", F.lit(day))
        write_table(load, config, "debit_transactions_silver", mode="replace_partition", partition_by=["ingestion_date"])
        increments.update_features(spark, config, day)
    return _rounded_summary(increments.summary_from_state(spark, config, _salary(spark, sf_dir)))


@_query
def gold_ratios(spark, sf_dir):
    return gold_summary(spark, sf_dir).select(
        "customer_id", "discretionary_ratio", "fixed_commitment_ratio",
        "salary_to_spend_ratio", "recurring_spend_ratio",
    )


@_query
def gold_score(spark, sf_dir):
    return _rounded_score(_score(spark, sf_dir))


@_query
def gold_score_corrected(spark, sf_dir):
    return _rounded_score(
        gold.gold_score_corrected(_debit(spark, sf_dir), _salary(spark, sf_dir), AS_OF)
    )


@_query
def audit_log(spark, sf_dir):
    """The stored audit log after two runs, with ids made from what they stand for."""
    config = PipelineConfig(work_dir(spark, "audit"))
    score = _rounded_score(_score(spark, sf_dir))
    for at in (AT, LATER):
        append_audit(gold.add_audit(score, at=at, ids="content"), config)
    return read_table(spark, config, "score_audit")


@_query
def audit_ids(spark, sf_dir):
    """How many random ids differ."""
    audited = gold.add_audit(_score(spark, sf_dir), at=AT)
    return audited.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("calculation_id").alias("ids")
    )


@_query
def audit_check(spark, sf_dir):
    """The audit log with a test of the id's form in place of the random id."""
    is_uuid = F.col("calculation_id").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")
    audited = gold.add_audit(_score(spark, sf_dir), at=AT)
    return audited.select(
        "customer_id", "sds_score", "score_month", "calculation_time", "calculated_by",
        is_uuid.cast("int").alias("id_is_uuid"),
    )


def _layered(spark, sf_dir):
    """The whole job from raw files to reports; where its tables are."""
    raw, root = work_dir(spark, "raw"), work_dir(spark, "tables")
    inputs = {
        "salary_income": (fixtures.salary_income, "parquet"),
        "transactions": (fixtures.transactions, "parquet"),
        "subscriptions": (fixtures.subscriptions, "parquet"),
        "credit_card_statements": (fixtures.credit_card_statements, "csv"),
    }
    sources = {}
    for name, (load, fmt) in inputs.items():
        sources[name] = SourceSpec(fmt, f"{raw}/{name}")
        options = {"header": "true"} if fmt == "csv" else {}
        load(spark, sf_dir).write.format(fmt).options(**options).save(sources[name].location)
    config = PipelineConfig(root, sources)
    pipeline.run_pipeline(spark, config, AS_OF, at=AT, months=MONTHS)
    return config


@_query
def layered_score(spark, sf_dir):
    """All layers written to files from raw files; the stored scores."""
    return _rounded_score(read_table(spark, _layered(spark, sf_dir), "score"))


@_query
def layered_histogram(spark, sf_dir):
    """The same, the stored histogram."""
    return read_table(spark, _layered(spark, sf_dir), "score_histogram")


@_query
def layered_pivot(spark, sf_dir):
    """The same, the stored spend by months."""
    return _round(read_table(spark, _layered(spark, sf_dir), "pivot_months"), 2, *MONTHS)


@_query
def rerun_after_failure(spark, sf_dir):
    """A named run that fails after its second table and is started again, in append mode: rows of each table."""
    raw, root = work_dir(spark, "raw"), work_dir(spark, "tables")
    sources = {}
    for name in ("salary_income", "transactions", "subscriptions", "credit_card_statements"):
        sources[name] = SourceSpec("parquet", f"{raw}/{name}")
        getattr(fixtures, name)(spark, sf_dir).write.parquet(sources[name].location)
    config = PipelineConfig(root, sources)

    def fail(name):
        if name == "transactions":
            raise InterruptedError(name)

    try:
        pipeline.run_bronze(spark, config, AS_OF, run="first", on_stored=fail)
    except InterruptedError:
        pipeline.run_bronze(spark, config, AS_OF, run="first")
    counts = [
        read_table(spark, config, name).agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("rows"))
        for name in (*sources, "debit_transactions")
    ]
    return reduce(DataFrame.unionByName, counts)


@_query
def reports_after_two_months(spark, sf_dir):
    """Scores of two months are kept; the reports are those of the newer."""
    config = PipelineConfig(work_dir(spark, "two-months"), score_mode="replace_partition")
    summary = stage(gold.gold_summary(_debit(spark, sf_dir), _salary(spark, sf_dir)), "summary")
    for day in (date(2024, 3, 1), AS_OF):
        scored = gold.score_customers(summary, day)
        write_table(scored, config, "score", mode=config.score_mode, partition_by=["score_month"])
    return pipeline.run_reports(spark, config)["score_histogram"]


# --- reports ----------------------------------------------------------------


@_query
def score_histogram(spark, sf_dir):
    return reports.score_histogram(_score(spark, sf_dir))


@_query
def ratio_counts(spark, sf_dir):
    return reports.ratio_counts(_score(spark, sf_dir), digits=6)


@_query
def ratio_buckets(spark, sf_dir):
    return reports.ratio_buckets(_score(spark, sf_dir))


@_query
def spend_boxstats(spark, sf_dir):
    stats = reports.spend_boxstats(stage(_cent_score(spark, sf_dir), "cent-score"))
    return _round(_round(stats, 4, "q1", "median", "q3"), 2, "lo", "hi")


@_query
def spend_boxstats_selected(spark, sf_dir):
    """The same where a range of more than 10 different rows is narrowed further."""
    stats = reports.spend_boxstats(stage(_cent_score(spark, sf_dir), "cent-score"), max_rows=10)
    return _round(_round(stats, 4, "q1", "median", "q3"), 2, "lo", "hi")


@_query
def spend_outliers(spark, sf_dir):
    return reports.spend_outliers(stage(_cent_score(spark, sf_dir), "cent-score"))


@_query
def scatter_points(spark, sf_dir):
    points = reports.scatter_points(_score(spark, sf_dir))
    return _round(points, 6, "salary_to_spend_ratio", "discretionary_ratio")


@_query
def spend_share(spark, sf_dir):
    share = reports.spend_share(_score(spark, sf_dir), by="bucket")
    return _round(_round(share, 2, "total_spend"), 6, "percent")


@_query
def spend_share_by_ratio(spark, sf_dir):
    """Slices as the chart groups them, with the ratio rounded beforehand."""
    score = _round(_score(spark, sf_dir), 6, "discretionary_ratio")
    return _round(_round(reports.spend_share(score, by="ratio"), 2, "total_spend"), 6, "percent")


@_query
def top_spenders(spark, sf_dir):
    return _round(reports.top_spenders(_score(spark, sf_dir)), 2, "total_spend")


@_query
def correlations(spark, sf_dir):
    return _round(reports.correlations(_score(spark, sf_dir)), 6, "r")


# --- text -------------------------------------------------------------------


@_query
def nearest_category(spark, sf_dir):
    return _round(text.nearest_category(_debit(spark, sf_dir)), 6, "similarity")


@_query
def nearest_category_char3(spark, sf_dir):
    matched = text.nearest_category(
        _debit(spark, sf_dir), tokenizer="char3", min_similarity=0.1
    )
    return _round(matched, 6, "similarity")


@_query
def nearest_category_table(spark, sf_dir):
    """The examples as a table, whose frequent tokens are those of more than two examples."""
    listed = examples.examples_table(spark)
    return _round(examples.nearest_of_many(_debit(spark, sf_dir), listed, postings=2), 6, "similarity")


@_query
def label_nearest(spark, sf_dir):
    rows = text.label_nearest(_debit(spark, sf_dir), tokenizer="char3", min_similarity=0.1)
    return rows.select("customer_id", "txn_date", "amount", "merchant", "category")


# --- streaming --------------------------------------------------------------


@_query
def stream_debit(spark, sf_dir):
    """Raw transaction files as a stream; the labelled debits it has written."""
    raw, out, log = (work_dir(spark, f"stream-{part}") for part in ("raw", "debit", "log"))
    batch = fixtures.transactions(spark, sf_dir)
    batch.write.parquet(raw)
    stream = streams.stream_debit(streams.stream_files(spark, raw, batch.schema), AS_OF)
    streams.write_stream(stream, out, log).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


@_query
def stream_daily_spend(spark, sf_dir):
    """Days that the watermark has closed, from the event table as a stream."""
    out, log = (work_dir(spark, f"stream-{part}") for part in ("days", "log"))
    table = f"{sf_dir.rstrip('/')}/events.parquet"
    # a stream source is a folder or a pattern; the pattern fits one file as well
    pattern = f"{sf_dir.rstrip('/')}/event[s].parquet"
    raw = streams.stream_files(spark, pattern, spark.read.parquet(table).schema)
    stream = streams.stream_daily_spend(fixtures.event_columns(raw))
    streams.write_stream(stream, out, log).awaitTermination()
    return _round(spark.read.schema(stream.schema).parquet(out), 2, "daily_spend")


@_query
def stream_daily_spend_update(spark, sf_dir):
    """The same stream in mode "update": open days too, each with its newest sum, which is all that a fold keeps."""
    config, log = PipelineConfig(work_dir(spark, "stream-update")), work_dir(spark, "stream-log")
    table = f"{sf_dir.rstrip('/')}/events.parquet"
    pattern = f"{sf_dir.rstrip('/')}/event[s].parquet"
    raw = streams.stream_files(spark, pattern, spark.read.parquet(table).schema)
    stream = streams.stream_daily_spend(fixtures.event_columns(raw))
    keys = ["customer_id", "txn_date"]
    streams.stream_to_table(stream, config, "daily_spend_stream", log, output_mode="update").awaitTermination()
    compact(spark, config, "daily_spend_stream", log, keys=keys)
    days = streams.latest_rows(read_table(spark, config, "daily_spend_stream"), keys)
    return _round(days, 2, "daily_spend")


@_query
def stream_to_score(spark, sf_dir):
    """Raw transaction files by way of a stream into bronze, from there to the stored scores."""
    raw, root, log = (work_dir(spark, f"stream-{part}") for part in ("in", "tables", "log"))
    config = PipelineConfig(root)
    batch = fixtures.transactions(spark, sf_dir)
    batch.write.parquet(raw)
    stream = streams.stream_debit(streams.stream_files(spark, raw, batch.schema), AS_OF)
    streams.stream_to_table(
        stream, config, "debit_transactions_stream", log, partition_by=["ingestion_date"]
    ).awaitTermination()
    _store_salary(config, _salary(spark, sf_dir))
    pipeline.run_silver(spark, config, debit_tables=["debit_transactions_stream"])
    return _rounded_score(pipeline.run_gold(spark, config, AS_OF, at=AT)["score"])


def _event_files(spark, sf_dir, files):
    """The event table as a stream of so many files, each with rows of all days; a file is a batch."""
    raw = work_dir(spark, "stream-events")
    table = fixtures._read(spark, sf_dir, "events")
    table.repartition(files).write.parquet(raw)
    return fixtures.event_columns(streams.stream_files(spark, raw, table.schema, maxFilesPerTrigger="1"))


@_query
def stream_daily_spend_late(spark, sf_dir):
    """Events out of order in four batches: closed days, open days and the late rows folded in."""
    config, log = PipelineConfig(work_dir(spark, "stream-late")), work_dir(spark, "stream-log")
    late.stream_daily_spend_kept(_event_files(spark, sf_dir, 4), config, log).awaitTermination()
    days = late.corrected_daily_spend(spark, config, with_open=True).drop("late_rows")
    return _round(days, 2, "daily_spend")


@_query
def stream_compacted(spark, sf_dir):
    """Events by way of 50 batches into a table that is folded, repeated in part and folded again; its sums by day."""
    config, log = PipelineConfig(work_dir(spark, "stream-folded")), work_dir(spark, "stream-log")
    name = "daily_spend_stream"
    streams.stream_to_table(_event_files(spark, sf_dir, 50), config, name, log).awaitTermination()
    last = committed_batch(spark, log)
    again = read_batches(spark, config, name).filter(F.col("batch") == last)
    again = stage(again, "again")
    compact(spark, config, name, log)
    write_table(again, config, name, mode="replace_partition", partition_by=["batch"])
    compact(spark, config, name, log)
    days = read_batches(spark, config, name).groupBy("customer_id", F.to_date("ts").alias("txn_date")).agg(F.sum("amount").alias("daily_spend"))
    return _round(days, 2, "daily_spend")
