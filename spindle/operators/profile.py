"""Profiling aggregates (AGG-01..AGG-13, ORD-01/02, SNK-08).

Every profile is a partial + final hash aggregate: a hot value (a third of
all rows in one group) is combined map-side before the shuffle, so no task
ever receives the raw rows of one group.  Several columns are profiled in
one scan by unpivoting to ``(column, value)`` instead of one job per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from .quantile import approx_quantiles, exact_quantiles


def _sql_text(name: str) -> str:
    """A column name as a SQL string literal (quotes doubled)."""
    return "'" + name.replace("'", "''") + "'"


def row_count(df: DataFrame, alias: str = "n_rows") -> DataFrame:
    """AGG-01 / AGG-05: one row, 0 for empty input."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def frequency(df: DataFrame, col: str, n: int | None = None,
              count_col: str = "count") -> DataFrame:
    """AGG-02 (+ ORD-01/02): value counts, most frequent first, ties by value
    ascending (nulls first), null is its own group; top ``n`` if given."""
    out = (df.groupBy(col).agg(F.count(F.lit(1)).alias(count_col))
           .orderBy(F.desc(count_col), F.asc_nulls_first(col)))
    return out.limit(n) if n is not None else out


def frequency_many(df: DataFrame, cols: Sequence[str], count_col: str = "count") -> DataFrame:
    """AGG-03: value counts of many columns in one scan and one shuffle.

    Values are cast to text so the columns share one ``value`` column."""
    cols = list(cols)
    as_text = df.select([F.col(c).cast("string").alias(c) for c in cols])
    long = as_text.unpivot([], cols, "column", "value")
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias(count_col))


def top_k_per_group(df: DataFrame, group: str | Sequence[str], value: str, k: int,
                    count_col: str = "count", rank_col: str = "rank") -> DataFrame:
    """AGG-10: the ``k`` most frequent ``value`` per group (ties by value).

    The window after the count is planned with a partial ``WindowGroupLimit``
    before its shuffle, so a huge group sends only its local top ``k``."""
    groups = [group] if isinstance(group, str) else list(group)
    counts = df.groupBy(*groups, value).agg(F.count(F.lit(1)).alias(count_col))
    w = Window.partitionBy(*groups).orderBy(F.desc(count_col), F.asc_nulls_first(value))
    return counts.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def null_nan_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """AGG-07: per column, the number of NaN values (float/double columns
    only, 0 for others) and of null values; one scan, long result."""
    cols = list(cols or df.columns)
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    aggs = []
    for i, c in enumerate(cols):
        is_float = isinstance(types[c], (DoubleType, FloatType))
        nan = F.count_if(F.isnan(c)) if is_float else F.lit(0).cast("bigint")
        aggs += [nan.alias(f"nan_{i}"), F.count_if(F.col(c).isNull()).alias(f"null_{i}")]
    wide = df.agg(*aggs)
    pairs = ", ".join(f"{_sql_text(c)}, nan_{i}, null_{i}" for i, c in enumerate(cols))
    return wide.selectExpr(f"stack({len(cols)}, {pairs}) as (column, n_nan, n_null)")


def summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AGG-09: typed ``describe``: count, mean, sample stddev, min, max per
    column in one pass (``describe`` itself returns text)."""
    cols = list(cols)
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"c{i}"), F.avg(x).alias(f"m{i}"),
                 F.stddev_samp(x).alias(f"s{i}"), F.min(x).alias(f"lo{i}"),
                 F.max(x).alias(f"hi{i}")]
    wide = df.agg(*aggs)
    parts = ", ".join(f"{_sql_text(c)}, c{i}, m{i}, s{i}, lo{i}, hi{i}" for i, c in enumerate(cols))
    return wide.selectExpr(
        f"stack({len(cols)}, {parts}) as (column, count, mean, stddev, min, max)")


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 10) -> DataFrame:
    """AGG-08: equal-width histogram per numeric column, numpy's rule: edges
    from min to max, last bin closed; a constant column uses the range
    ``[v - 0.5, v + 0.5]`` (or a billionth of ``v`` on each side, where that is
    more).  Empty bins are reported with count 0; an infinite value is an error.

    The per-column range frame has one row per column (bounded by the schema,
    not the data) and is broadcast into the value scan."""
    cols = list(cols)
    long = (df.select([F.col(c).cast("double").alias(c) for c in cols])
            .unpivot([], cols, "column", "x")
            .where(F.col("x").isNotNull() & ~F.isnan("x")))
    pad = F.greatest(F.lit(0.5), F.abs("mn") * 1e-9)
    finite = F.when((F.abs("mn") < float("inf")) & (F.abs("mx") < float("inf")), F.col("mn")).otherwise(
        F.raise_error(F.concat(F.lit("histogram: infinite value in "), "column")).cast("double"))
    rng = (long.groupBy("column").agg(F.min("x").alias("mn"), F.max("x").alias("mx"))
           .select("column",
                   F.when(F.col("mn") == F.col("mx"), F.col("mn") - pad).otherwise(finite).alias("lo"),
                   F.when(F.col("mn") == F.col("mx"), F.col("mx") + pad).otherwise(F.col("mx")).alias("hi")))
    b = F.least(F.floor((F.col("x") - F.col("lo")) * bins / (F.col("hi") - F.col("lo"))),
                F.lit(bins - 1)).cast("int")
    counts = (long.join(F.broadcast(rng), "column")
              .groupBy("column", b.alias("bin")).agg(F.count(F.lit(1)).alias("count")))
    grid = rng.select("column", "lo", "hi",
                      F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("hi") - F.col("lo")) / bins
    return (grid.join(counts, ["column", "bin"], "left")
            .select("column", "bin",
                    (F.col("lo") + F.col("bin") * width).alias("bin_lo"),
                    F.when(F.col("bin") == bins - 1, F.col("hi"))
                    .otherwise(F.col("lo") + (F.col("bin") + 1) * width).alias("bin_hi"),
                    F.coalesce(F.col("count"), F.lit(0).cast("bigint")).alias("count")))


def histogram_by(df: DataFrame, by: str, cols: Sequence[str], bins: int = 10) -> DataFrame:
    """AGG-08 per category: ``group, column, bin, bin_lo, bin_hi, count``.

    Edges are those of :func:`histogram` over all rows, so the bars of the
    categories of one column stand over the same bins and can be stacked; a null
    category is one of its own.  A category has all bins of every column in which
    it has a value, empty ones with count 0.  Null and NaN values are left out, an
    infinite value is an error, and a column without values gives no rows.

    Two scans: ranges (one row per column, broadcast), then counts, which are
    combined before the shuffle, so a category with most of the rows is no hot
    task.  The empty bins come from an array of ``bins`` counts per category and
    column, not from a join."""
    cols = list(cols)
    if bins < 1:
        raise ValueError("histogram_by: at least one bin")
    long = (df.select(F.col(by).alias("group"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
            .unpivot(["group"], [f"x{i}" for i in range(len(cols))], "place", "x")
            .where(F.col("x").isNotNull() & ~F.isnan("x")))
    pad = F.greatest(F.lit(0.5), F.abs("mn") * 1e-9)
    finite = (F.abs("mn") < float("inf")) & (F.abs("mx") < float("inf"))
    names = F.element_at(F.array(*[F.lit(c) for c in cols]), F.substring("place", 2, 9).cast("int") + 1)
    rng = (long.groupBy("place").agg(F.min("x").alias("mn"), F.max("x").alias("mx"))
           .withColumn("column", names)
           .withColumn("mn", F.when(finite, F.col("mn")).otherwise(
               F.raise_error(F.concat(F.lit("histogram_by: infinite value in "), "column")).cast("double")))
           .select("place", "column", F.when(F.col("mn") == F.col("mx"), F.col("mn") - pad).otherwise(F.col("mn")).alias("lo"),
                   F.when(F.col("mn") == F.col("mx"), F.col("mx") + pad).otherwise(F.col("mx")).alias("hi")))
    b = F.least(F.floor((F.col("x") - F.col("lo")) * bins / (F.col("hi") - F.col("lo"))), F.lit(bins - 1)).cast("int")
    counts = (long.join(F.broadcast(rng), "place")
              .groupBy("group", "column", "lo", "hi", b.alias("bin")).agg(F.count(F.lit(1)).alias("n")))
    held = counts.groupBy("group", "column", "lo", "hi").agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("held"))
    filled = F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: F.coalesce(F.col("held")[i], F.lit(0).cast("bigint")))
    width = (F.col("hi") - F.col("lo")) / bins
    return (held.select("group", "column", "lo", "hi", F.posexplode(filled).alias("bin", "count"))
            .select("group", "column", "bin", (F.col("lo") + F.col("bin") * width).alias("bin_lo"),
                    F.when(F.col("bin") == bins - 1, F.col("hi")).otherwise(F.col("lo") + (F.col("bin") + 1) * width).alias("bin_hi"),
                    "count"))


def quartiles(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """AGG-11: Q1, median and Q3 per column, linear interpolation."""
    probs = [0.25, 0.5, 0.75]
    q = (exact_quantiles if exact else approx_quantiles)(df, cols, probs)
    rows = [(c, q[(c, 0.25)], q[(c, 0.5)], q[(c, 0.75)]) for c in cols]
    return df.sparkSession.createDataFrame(rows, "column string, q1 double, median double, q3 double")


def iqr_bounds(df: DataFrame, cols: Sequence[str], k: float = 1.5, exact: bool = True) -> dict:
    """``{column: (q1, q3, low fence, high fence)}`` with fences ``q -/+ k*IQR``."""
    q = (exact_quantiles if exact else approx_quantiles)(df, cols, [0.25, 0.75])
    out = {}
    for c in cols:
        q1, q3 = q[(c, 0.25)], q[(c, 0.75)]
        if q1 is None:
            out[c] = (None, None, None, None)
        else:
            out[c] = (q1, q3, q1 - k * (q3 - q1), q3 + k * (q3 - q1))
    return out


def boxplot_stats(df: DataFrame, cols: Sequence[str], k: float = 1.5, exact: bool = True) -> DataFrame:
    """AGG-12: quartiles, fences, whiskers (the extreme values inside the
    fences) and the number of values outside, per column; one extra scan."""
    bounds = iqr_bounds(df, cols, k, exact)
    aggs = []
    for i, c in enumerate(cols):
        q1, q3, lo, hi = bounds[c]
        x = F.col(c).cast("double")
        if lo is None:
            aggs += [F.lit(None).cast("double").alias(f"wl{i}"), F.lit(None).cast("double").alias(f"wh{i}"),
                     F.lit(0).cast("bigint").alias(f"o{i}")]
            continue
        inside = (x >= F.lit(lo)) & (x <= F.lit(hi))
        outside = ~F.isnan(x) & ((x < F.lit(lo)) | (x > F.lit(hi)))  # NaN sorts above all
        aggs += [F.min(F.when(inside, x)).alias(f"wl{i}"), F.max(F.when(inside, x)).alias(f"wh{i}"),
                 F.count_if(outside).alias(f"o{i}")]
    wide = df.agg(*aggs)

    def lit(v):
        return "CAST(NULL AS DOUBLE)" if v is None else f"CAST({v!r} AS DOUBLE)"
    parts = ", ".join(
        f"{_sql_text(c)}, {lit(bounds[c][0])}, {lit(bounds[c][1])}, {lit(bounds[c][2])}, {lit(bounds[c][3])}, "
        f"wl{i}, wh{i}, o{i}" for i, c in enumerate(cols))
    return wide.selectExpr(
        f"stack({len(cols)}, {parts}) as (column, q1, q3, fence_lo, fence_hi, "
        "whisker_lo, whisker_hi, n_outliers)")


def duplicate_keys(df: DataFrame, keys: str | Sequence[str], count_col: str = "count") -> DataFrame:
    """AGG-13: keys that occur more than once, most repeated first."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
            .where(F.col(count_col) > 1)
            .orderBy(F.desc(count_col), *[F.asc_nulls_first(k) for k in keys]))


def preview(df: DataFrame, order_by: Sequence[str], n: int = 20) -> DataFrame:
    """SNK-08: the first ``n`` rows under a total order (``TakeOrderedAndProject``)."""
    return df.orderBy(*[F.asc_nulls_first(c) for c in order_by]).limit(n)
