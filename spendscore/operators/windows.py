"""Window operators that hold up when one key has a third of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendscore.functions.expressions import month_index, null_skipping_sum
from spendscore.operators.skew import (
    HOT_ROWS,
    expand_copies,
    heavy_keys,
    join_by_key,
    split_heavy,
)


def with_total_spend(
    debit: DataFrame,
    *,
    key: str = "customer_id",
    value: str = "amount",
    name: str = "total_spend",
    hot_rows: int = HOT_ROWS,
    digits: int | None = None,
) -> DataFrame:
    """Every row with the sum of ``value`` over all rows of its key.

    Plain keys use one window. Heavy keys get their total, a combining
    aggregate, by broadcast; their rows are not shuffled at all. The two add in different orders, so the last bits of a
    total of doubles may differ between them, as between any two runs; ``digits`` rounds it to what both agree on.
    """
    # counted and summed at once: the heavy rows come with their total
    heavy = heavy_keys(debit, [key], hot_rows=hot_rows, **{name: F.sum(value)})
    hot, cold = split_heavy(debit, heavy, [key])
    both = cold.withColumn(name, F.sum(value).over(Window.partitionBy(key))).unionByName(hot)
    return both if digits is None else both.withColumn(name, F.round(name, digits))


def rolling_rows(
    debit: DataFrame,
    n: int = 3,
    *,
    keys: Sequence[str] = ("customer_id", "category"),
    order_by: tuple[str, str] = ("txn_date", "amount"),
    value: str = "amount",
    name: str = "three_month_category_spend",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Sum of ``value`` over a row and the ``n - 1`` rows before it in its group.

    Rows are taken by ``order_by`` (a period column and a number); ties by a hash of the
    remaining columns and then by these, so the rows do not depend on arrival.
    """
    heavy = heavy_keys(debit, keys, hot_rows=hot_rows)
    hot, cold = split_heavy(debit, heavy, keys)
    plain = _rolling(cold, n, keys, order_by, value, name)
    # a heavy group is cut unless ``hot_rows`` is so small that it fits a chunk
    cut = heavy_keys(debit, keys, hot_rows=_LEAST_CHUNK) if hot_rows < _LEAST_CHUNK else None
    return plain.unionByName(_rolling_in_chunks(hot, n, keys, order_by, value, name, hot_rows, cut))


def spend_windows(
    debit: DataFrame,
    n: int = 3,
    *,
    key: str = "customer_id",
    group: str = "category",
    order_by: tuple[str, str] = ("txn_date", "amount"),
    value: str = "amount",
    total: str = "total_spend",
    rolling: str = "three_month_category_spend",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Both windows at once: the total of a row's ``key`` and the rolling sum of its ``key`` and ``group``.

    Rows that lie together by ``key`` also do by (``key``, ``group``), so one shuffle of the rows serves both.
    Heavy keys are found and summed once; their totals come by broadcast, and their rows are shuffled
    once too, into the chunks of the rolling sum.
    """
    summing = {total: F.sum(value)}
    heavy = heavy_keys(debit, [key], hot_rows=hot_rows, **summing)
    hot, cold = split_heavy(debit, heavy, [key])
    summed = cold.withColumn(total, F.sum(value).over(Window.partitionBy(key)))
    plain = _rolling(summed, n, (key, group), order_by, value, rolling, ties=_ties(debit, (key, group), order_by))
    # only a key that doesn't fit a chunk can have a group that doesn't
    most = max(hot_rows, _LEAST_CHUNK)
    large = join_by_key(debit, heavy_keys(debit, [key], hot_rows=most, **summing), [key])
    cut = heavy_keys(large, [key, group], hot_rows=most)
    return plain.unionByName(_rolling_in_chunks(hot, n, (key, group), order_by, value, rolling, hot_rows, cut, along=(total,)))


def _ties(debit: DataFrame, keys: Sequence[str], order_by: tuple[str, str]) -> list[str]:
    return [column for column in debit.columns if column not in (*keys, *order_by)]


def _tie_hash(ties: Sequence[str]) -> Column:
    """What orders rows of one period and number: heavy ones are cut by its leading bits."""
    return F.xxhash64(*ties) if ties else F.lit(0).cast("long")


def _rolling(rows, n, keys, order_by, value, name, ties=None) -> DataFrame:
    """The sums where a group fits a task. Values are added from the row itself
    backwards, as for heavy groups, so both ways give the same bits."""
    ties = _ties(rows, keys, order_by) if ties is None else ties
    in_order = Window.partitionBy(*keys).orderBy(*order_by, _tie_hash(ties), *ties)
    terms = [F.col(value)] + [F.lag(value, back).over(in_order) for back in range(1, n)]
    return rows.withColumn(name, null_skipping_sum(terms))


# Slices per factor e of the amount: a slice spans about 1.6 percent, and a heavy one is cut into this many.
_SLICES_PER_E = 64
_SUB_SLICES = 4096
# Rows of one period and number that are still one chunk whatever ``hot_rows`` says, and the bits of most chunks they are cut into.
_LEAST_CHUNK = 10_000
_MOST_BITS = 20


def _slice_of(number: Column, per_e: int = _SLICES_PER_E) -> Column:
    """A slice number that never falls as ``number`` grows.

    Slices widen with the amount, so large and small ones are cut alike. A plain
    function of the row gives the same slice whenever it is computed again.
    """
    size = F.least(F.log1p(F.abs(number)), F.lit(1e6))  # infinite amounts have a slice too
    cut = (F.floor(size * per_e) * F.signum(number)).cast("long")
    return F.when(F.isnan(number), F.lit(2**31 * per_e)).otherwise(cut)


def _chunked(hot: DataFrame, keys, order_by, ties, hot_rows: int) -> DataFrame:
    """``hot`` with ``_chunk``, a struct that cuts groups along their order, and ``_hash``.

    Chunks are a period and a slice of the number. A slice with too many rows is cut into finer ones, and in
    these, a number with too many rows (point) into buckets by the leading bits of the ties' hash. Which slices
    and points that are is counted by a combining aggregate; there are fewer than rows / ``hot_rows``
    of them, as of heavy keys, which bounds both broadcasts.
    """
    period, number = order_by
    most = max(hot_rows, _LEAST_CHUNK)
    bucket_rows = max(hot_rows // 8, _LEAST_CHUNK)
    place = [*keys, period, "_slice"]
    sliced = hot.withColumns({"_slice": _slice_of(F.col(number)), "_hash": _tie_hash(ties)})
    full = (sliced.groupBy(*place).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > most)
            .select(*place, F.lit(True).alias("_full")))
    finer = F.when(F.col("_full"), _slice_of(F.col(number), _SLICES_PER_E * _SUB_SLICES))
    fine = join_by_key(sliced, full, place, "left").withColumn("_sub", F.coalesce(finer, F.lit(0)))
    bits = F.least(F.ceil(F.log2(F.col("_rows") / bucket_rows)).cast("int"), F.lit(_MOST_BITS))
    points = (
        fine.filter("_full").groupBy(*place, "_sub", F.col(number).alias("_number")).agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") > most).groupBy(*place, "_sub")
        .agg(F.sort_array(F.collect_list(F.struct("_number", F.greatest(bits, F.lit(0)).alias("_bits")))).alias("_points"))
    )
    at = join_by_key(fine, points, [*place, "_sub"], "left")
    # Between two points, below the first and above the last, rows of a sub-slice are chunks of their own.
    own = F.filter("_points", lambda p: p["_number"].eqNullSafe(F.col(number)))
    below = F.size(F.filter("_points", lambda p: p["_number"] < F.col(number)))
    part = F.when(F.col("_points").isNull(), 0).otherwise(2 * below + F.size(own))
    # The hash's sign bit is turned, so that leading bits follow the order of signed numbers.
    unsigned = F.col("_hash").bitwiseXOR(F.lit(-(2**63)))
    bucket = F.expr("shiftrightunsigned(_turned, 64 - _bits)")
    bucket = F.when(F.coalesce(F.col("_bits"), F.lit(0)) > 0, bucket).otherwise(F.lit(0).cast("long"))
    return (
        at.withColumns({"_part": part, "_bits": F.get(own, F.lit(0))["_bits"], "_turned": unsigned})
        .withColumn("_chunk", F.struct(*keys, period, "_slice", "_sub", "_part", bucket.alias("_bucket")))
        .drop("_slice", "_full", "_sub", "_points", "_part", "_bits", "_turned")
    )


def _rolling_in_chunks(hot, n, keys, order_by, value, name, hot_rows, cut=None, along=()) -> DataFrame:
    """The same sums for heavy groups, without sorting a group in one task.

    A group is cut along its order into chunks; of the groups only those in ``cut``, if it is given: any other is one chunk.
    ``along`` are columns that a key decides.
    """
    ties = [column for column in _ties(hot, keys, order_by) if column not in along]
    columns = (n, keys, order_by, [*ties, *along], value, name)
    if cut is None:
        return _chunk_sums(_chunked(hot, keys, order_by, ties, hot_rows), *columns)
    long, short = split_heavy(hot, cut, keys)
    whole = short.withColumns({"_chunk": F.struct(*keys), "_hash": _tie_hash(ties)})
    in_chunks = _chunk_sums(_chunked(long, keys, order_by, ties, hot_rows), *columns)
    return in_chunks.unionByName(_chunk_sums(whole, *columns, carry=False))


def _chunk_sums(chunked, n, keys, order_by, others, value, name, carry=True) -> DataFrame:
    """The sums of rows that have their ``_chunk`` and ``_hash``.

    Each chunk is summed by itself; with ``carry``, its first
    ``n - 1`` rows then receive the values that precede the chunk. Equal rows are counted before
    the shuffle: beyond the n-th, all copies have ``n`` times their own value.
    """
    period, number = order_by
    # one key for the chunk: unknown parts are equal in a struct, and the window
    # and the join below share its partitioning
    counted = chunked.groupBy("_chunk", period, "_hash", number, *others).agg(F.count(F.lit(1)).alias("_copies"))
    # up to n copies take part in the windows; no row can see further back
    first_copies = F.sequence(F.lit(1).cast("long"), F.least("_copies", F.lit(n)))
    unrolled = counted.withColumn("_copy", F.explode(first_copies)).drop("_copies")
    of_row = [*[F.col("_chunk")[key].alias(key) for key in keys], period, number, *others]
    further = counted.filter(F.col("_copies") > n).select(
        *of_row, null_skipping_sum([F.col(value)] * n).alias(name), (F.col("_copies") - n).alias("_copies")
    )

    in_chunk = Window.partitionBy("_chunk").orderBy(period, number, "_hash", *others, "_copy")
    backs = {back: F.lag(value, back).over(in_chunk) for back in range(1, n)}
    if not carry:
        summed = unrolled.select(*of_row, null_skipping_sum([F.col(value), *backs.values()]).alias(name))
        return summed.unionByName(expand_copies(further, "_copies"))
    local = (
        unrolled.withColumn("_at", F.row_number().over(in_chunk))
        .withColumns({f"_back{back}": lag for back, lag in backs.items()})
        .withColumn("_last", F.lead(F.lit(1), n - 1).over(in_chunk).isNull())
    )
    # the row's own chunk first, then the last rows of the chunks before it
    parts = [F.col(value)] + [
        F.when(F.col("_at") > back, F.col(f"_back{back}")).otherwise(F.get("_before", back - F.col("_at")))
        for back in range(1, n)
    ]
    ends = local.filter(F.col("_last") if n > 1 else F.lit(False)).select("_chunk", "_at", F.col(value).alias("_value"))
    summed = local.join(_carried(ends, n, len(keys)), F.col("_chunk") == F.col("_next"), "left").select(
        *of_row, null_skipping_sum(parts).alias(name)
    )
    return summed.unionByName(expand_copies(further, "_copies"))


def _carried(ends: DataFrame, n: int, n_keys: int) -> DataFrame:
    """Per chunk (``_next``) the up to ``n - 1`` values that precede it in its group, nearest first.

    ``ends`` are the last rows of every chunk. They are carried along in levels: over the chunks of a slice, the slices of a
    period and the periods of a group. A level's window holds ``n - 1`` rows for each part of
    what it is over, never all chunks of a group.
    """
    fields = ends.schema["_chunk"].dataType.names
    levels = [len(fields), n_keys + 2, n_keys + 1, n_keys]

    def node(depth: int) -> Column:
        return F.struct(*[F.col("_chunk")[name].alias(name) for name in fields[:depth]])

    carries = []
    for depth, above in zip(levels, levels[1:]):
        in_parent = Window.partitionBy("_parent").orderBy("_node", "_at")
        lags = F.array(*[F.lag("_value", back).over(in_parent) for back in range(1, n)]) if n > 1 else F.array("_value")
        at = F.row_number().over(in_parent)
        placed = ends.withColumns({"_parent": node(above), "_node": node(depth)}).withColumns(
            {
                "_first": ~F.col("_node").eqNullSafe(F.lag("_node").over(in_parent)),
                "_carry": F.slice(lags, F.lit(1), F.least(at - 1, F.lit(n - 1))),
                "_end": F.lead(F.lit(1), max(n - 1, 1)).over(in_parent).isNull(),
                "_place": at,
            }
        )
        carries.append(placed.filter("_first").select(F.col("_node").alias(f"_node{depth}"), F.col("_carry").alias(f"_carry{depth}")))
        ends = placed.filter("_end").select("_chunk", F.col("_place").alias("_at"), "_value")
    chunks = carries[0].withColumnsRenamed({f"_node{levels[0]}": "_chunk", f"_carry{levels[0]}": "_before"})
    for depth, carry in zip(levels[1:], carries[1:]):
        chunks = chunks.withColumn("_node", node(depth)).join(carry, F.col("_node") == F.col(f"_node{depth}"), "left")
        further = F.coalesce(F.col(f"_carry{depth}"), F.slice("_before", 1, 0))
        chunks = chunks.select("_chunk", F.concat("_before", further).alias("_before"))
    return chunks.withColumnRenamed("_chunk", "_next")


def rolling_months(
    debit: DataFrame,
    n: int = 3,
    *,
    keys: Sequence[str] = ("customer_id", "category"),
    name: str = "rolling_spend",
) -> DataFrame:
    """Spend per group and month, with the sum over it and ``n - 1`` months before.

    Rows are summed to months first, so a window holds one row per month.
    A month without spend counts as nothing.
    """
    monthly = debit.groupBy(
        *keys,
        F.year("txn_date").alias("year"),
        F.month("txn_date").alias("month"),
        month_index(F.col("txn_date")).alias("_index"),
    ).agg(F.sum("amount").alias("monthly_spend"))
    frame = Window.partitionBy(*keys).orderBy("_index").rangeBetween(-(n - 1), 0)
    return monthly.withColumn(name, F.sum("monthly_spend").over(frame)).drop("_index")
