"""Windows per key over rows in order. Frames count rows, not days; none looks at the future."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window, WindowSpec

from tidemark.functions.columns import col, safe_ratio, when_full
from tidemark.operators.storage import written

#: The widest window in which values are compared one by one.
COUNTED = 1024


def by(key: str = "ticker", order: str = "date") -> WindowSpec:
    return Window.partitionBy(key).orderBy(order)


def rolling_sum_ratio(num: str | Column, den: str | Column, over: WindowSpec, size: int = 5) -> Column:
    """Sum of num over the last rows by the sum of den: summed before divided; every value must be there."""
    w = over.rowsBetween(1 - size, 0)
    total = lambda c: when_full(F.sum(col(c)).over(w), F.count(col(c)).over(w), size)
    return safe_ratio(total(num), total(den))


def rolling_z(value: str | Column, over: WindowSpec, size: int = 252) -> Column:
    """Standard score against the size rows strictly before; NULL unless all are there and they vary.

    Spark goes through the frame anew for every row: for wide windows take ``with_rolling_z``.
    """
    w, x = over.rowsBetween(-size, -1), col(value)
    return F.when(F.count(x).over(w) == size, F.try_divide(x - F.avg(x).over(w), F.stddev_samp(x).over(w)))


def with_rolling_percentile(df: DataFrame, value: str, out: str, size: int = 756, key: str = "ticker", order: str = "date") -> DataFrame:
    """df with the share of the other rows of the window, this one included in it, that don't exceed this value.

    NULL unless all of the window's values are there.
    """
    return with_rolling(df, {out: (shares, value, size)}, key, order)


def with_rolling_z(df: DataFrame, values: Mapping[str, str], size: int = 252, key: str = "ticker", order: str = "date") -> DataFrame:
    """df with the standard scores of ``rolling_z``, out by value, at a cost a row that Spark's sliding frames don't have."""
    return with_rolling(df, {out: (scores, value, size) for out, value in values.items()}, key, order)


def shares(x: np.ndarray, missing: np.ndarray, place: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(value, whether it is missing) of the rolling percentile at each row.

    Rows of several keys follow each other; place is the row's among those of its key. The values that don't exceed a
    row's are counted lag by lag, over all rows at once; a window too wide for that is ranked by a skip list.
    """
    if size > COUNTED:
        rank = pd.Series(x).rolling(size, min_periods=size).rank(method="max").to_numpy()
    else:
        rank, few, lost = np.zeros(len(x)), np.zeros(len(x), np.uint8), np.concatenate([[0], np.cumsum(~np.isfinite(x))])
        for lag in range(min(size, len(x))):
            few[lag:] += (x[: len(x) - lag] <= x[lag:]).view(np.uint8)
            if lag % 255 == 254:
                rank, few = rank + few, np.zeros(len(x), np.uint8)
        rank = rank + few
        rank[size - 1 :][lost[size:] > lost[:-size]] = np.nan
    share = np.where(place >= size - 1, (rank - 1) / (size - 1 or np.nan), np.nan)
    return share, np.isnan(share)


def moments(x: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(mean, sum of squared deviations from it) of each size successive values, merged from windows of powers of two.

    All that goes into a window's moments is its own values, so nothing outside it, an outlier or no number, leaves an error.
    """

    def merged(a: tuple, b: tuple, m: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Moments of m values and the n after them."""
        b = [c[m:] for c in b]
        a = [c[: len(b[0])] for c in a]
        apart = b[0] - a[0]
        return a[0] + apart * (n / (m + n)), a[1] + b[1] + apart * apart * (m * n / (m + n))

    some, have, block, n = None, 0, (x, np.zeros(len(x))), 1
    while True:
        if size & n:
            some, have = merged(some, block, have, n) if have else block, have + n
        if have == size:
            return some
        block, n = merged(block, block, n, n), 2 * n


def scores(x: np.ndarray, missing: np.ndarray, place: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(value, whether it is missing) of the standard score against the size rows before each; place as in ``shares``.

    A window of equal values has no deviation, whatever their mean rounds to.
    """
    n, z, out = len(x), np.full(len(x), np.nan), np.ones(len(x), bool)
    if size < 2 or n <= size:
        return z, out
    before, at = np.concatenate([[0], np.cumsum(missing)]), np.arange(size, n)
    with np.errstate(all="ignore"):
        changed = np.maximum.accumulate(np.concatenate([[0], np.where(x[1:] != x[:-1], np.arange(1, n), 0)]))
        mean, squares = moments(x[:-1], size)
        deviation = np.sqrt(squares / (size - 1))
        z[size:] = (x[size:] - mean) / deviation
    out[size:] = missing[size:] | (place[size:] < size) | (before[at] > before[at - size]) | (changed[at - 1] <= at - size) | (deviation == 0)
    return z, out


def with_rolling(df: DataFrame, columns: Mapping[str, tuple[Callable, str, int]], key: str = "ticker", order: str = "date") -> DataFrame:
    """df with columns of rolling windows: out by (function of values, missing, places and size; value; size).

    Rows are dealt by key and stream in order; a function sees a batch, whatever keys are in it, after the last rows of
    the key that the batch goes on with, as many as the widest window.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([*df.schema.fields, *[T.StructField(out, T.DoubleType()) for out in columns]])
    target, at = to_arrow_schema(schema), {c: i for i, c in enumerate(df.columns)}
    values, held = list(dict.fromkeys(value for _, value, _ in columns.values())), max(size for _, _, size in columns.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, tails, tail = None, {}, 0
        for batch in batches:
            if not len(batch):
                continue
            runs = pc.run_end_encode(batch.column(at[key]))
            keys, ends = runs.values, runs.run_ends.to_numpy()
            tail = tail if keys[0].as_py() == last else 0
            arrays = {v: batch.column(at[v]) for v in values}
            seen = {v: (a.cast(pa.float64()).to_numpy(zero_copy_only=False), a.is_null().to_numpy(zero_copy_only=False)) for v, a in arrays.items()}
            if tail:
                seen = {v: tuple(map(np.concatenate, zip(tails[v], now, strict=True))) for v, now in seen.items()}
            begins = np.concatenate([[0], ends[:-1] + tail])
            place = np.arange(len(batch) + tail) - np.repeat(begins, np.diff(np.append(begins, len(batch) + tail)))
            made = {out: function(*seen[value], place, size) for out, (function, value, size) in columns.items()}
            old_columns = [c if c.type == f.type else c.cast(f.type) for c, f in zip(batch.columns, target, strict=False)]
            yield pa.RecordBatch.from_arrays([*old_columns, *[pa.array(x[tail:], pa.float64(), mask=missing[tail:]) for x, missing in made.values()]], schema=target)
            last, keep = keys[-1].as_py(), max(begins[-1], len(place) - held)
            tails, tail = {v: [c[keep:] for c in now] for v, now in seen.items()}, len(place) - keep

    return df.repartition(key).sortWithinPartitions(key, order).mapInArrow(run, schema)


def band(percentile: Column) -> Column:
    """Percentile as -1 to 1, low values high."""
    return (0.5 - percentile) * 2


def lagged_ratio(num: str | Column, den: str | Column, over: WindowSpec, lag: int = 3) -> Column:
    """Ratio of its own session, then moved by lag rows, as it is published later."""
    return F.lag(safe_ratio(num, den), lag).over(over)


def filled(value: str | Column, over: WindowSpec) -> Column:
    """Last value known up to this row."""
    return F.last(col(value), ignorenulls=True).over(over.rowsBetween(Window.unboundedPreceding, 0))


def pct_change(df: DataFrame, value: str, n: int, over: WindowSpec, out: str) -> DataFrame:
    """Change against n rows before; missing values take the last known one, a zero base gives NULL."""
    ready = df.withColumn("_filled", filled(value, over))
    return ready.withColumn(out, safe_ratio("_filled", F.lag("_filled", n).over(over)) - 1).drop("_filled")


def rolling_spread(value: str | Column, over: WindowSpec, size: int) -> Column:
    """Sample deviation of a full window."""
    w = over.rowsBetween(1 - size, 0)
    return when_full(F.stddev_samp(col(value)).over(w), F.count(col(value)).over(w), size)


def rolling_beta(x: str, y: str, over: WindowSpec, size: int) -> Column:
    """Slope of y on x over a full window of pairs; NULL where x doesn't vary."""
    w = over.rowsBetween(1 - size, 0)
    both = F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), 1)
    return when_full(F.try_divide(F.covar_samp(x, y).over(w), F.var_samp(x).over(w)), F.count(both).over(w), size)


def cumulative_return(ret: str | Column, over: WindowSpec) -> Column:
    """Compounded from the first row on."""
    return F.product(1 + col(ret)).over(over.rowsBetween(Window.unboundedPreceding, 0)) - 1


def change_over(df: DataFrame, key: str, order: str, value: str, back: int) -> DataFrame:
    """(key, last, change): last value and its difference to the one back values earlier, nulls not counted."""
    known = df.where(F.col(value).isNotNull())
    ranked = known.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order)))).where(F.col("_r").isin(1, back + 1))
    now, then = F.max(F.when(F.col("_r") == 1, F.col(value))), F.max(F.when(F.col("_r") == back + 1, F.col(value)))
    return ranked.groupBy(key).agg(now.alias("last"), (now - then).alias("change"))


def average_rank(value: str, *partition: str) -> Column:
    """Rank from 1 with ties sharing their mean rank."""
    same = F.count("*").over(Window.partitionBy(*partition, value))
    return F.rank().over(Window.partitionBy(*partition).orderBy(value)) + (same - 1) / 2


def correlation(df: DataFrame, x: str, y: str, *groups: str) -> DataFrame:
    """(groups, n, corr) over rows that have both values; NULL for one pair or a constant side.

    One aggregation, combined before it is shuffled, by merged moments about the mean.
    """
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*groups, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
    varies = (F.min("_x") < F.max("_x")) & (F.min("_y") < F.max("_y"))
    got = both.groupBy(*groups).agg(F.count("*").alias("n"), varies.alias("v"), F.covar_pop("_x", "_y").alias("xy"), F.var_pop("_x").alias("xx"), F.var_pop("_y").alias("yy"))
    return got.select(*groups, "n", F.when(F.col("v"), F.try_divide("xy", F.sqrt("xx") * F.sqrt("yy"))).alias("corr"))


def spearman(df: DataFrame, x: str, y: str, *groups: str) -> DataFrame:
    """(groups, n, corr): correlation of average ranks within each group."""
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    ranked = both.select(*groups, average_rank(x, *groups).alias("_rx"), average_rank(y, *groups).alias("_ry"))
    return correlation(ranked, "_rx", "_ry", *groups)


def running_total(df: DataFrame, amount: str | Column, out: str, *order: str | Column) -> DataFrame:
    """df with the sum of amount over the rows before each in a global order; ties must be broken by the order.

    Rows are dealt to ranges of the order and written, which fixes the ranges; their totals, a row a range,
    are carried over them. So no task sees more than a range.
    """
    ranged = written(df.withColumn("_amount", col(amount)).repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    totals = ranged.groupBy("_range").agg(F.sum("_amount").alias("_sum"))
    ahead = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    begins = totals.select("_range", F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_begin"))  # a row a range
    before = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inner = F.coalesce(F.sum("_amount").over(before), F.lit(0))
    return ranged.join(F.broadcast(begins), "_range").withColumn(out, F.col("_begin") + inner).drop("_amount", "_range", "_begin")


def placed(df: DataFrame, out: str, *order: str | Column) -> DataFrame:
    """df with each row's place in a global order, from 1."""
    return running_total(df, F.lit(1), out, *order).withColumn(out, (F.col(out) + 1).cast("int"))
