"""Feature engineering: calendar, price, lag and rolling columns in one projection.

All window columns share one spec (series keys, date order), so the plan has a single
Exchange (hash on the series keys), a single Sort and a single Window node. Rolling
frames read the target directly over rows ``[-n, -1]`` -- the same values as a rolling
window over the lag-1 column, without a second Window node.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from shelfcast.functions.calendar import calendar_columns
from shelfcast.functions.price import discount_pct, price_vs_competitor
from shelfcast.spec import RETAIL, PanelSpec
from shelfcast.session import reliable_checkpoint


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def series_order(spec: PanelSpec, columns=()) -> list[Column]:
    """Order of the rows of a series: date, tie-breakers, then all other columns, so that only
    rows equal in every column tie. Every path below uses this one order."""
    first = (spec.date, *spec.tie_breakers)
    rest = [c for c in columns if c not in first and c not in spec.series_keys]
    return [F.asc_nulls_first(f"`{c}`") for c in (*first, *rest)]


def series_window(spec: PanelSpec = RETAIL, partition_extra: tuple[str, ...] = (), columns=()) -> WindowSpec:
    order = series_order(spec, columns)
    return Window.partitionBy(*[_q(k) for k in spec.series_keys + partition_extra]).orderBy(*order)


def calendar_features(spec: PanelSpec = RETAIL) -> dict[str, Column]:
    return calendar_columns(_q(spec.date), spec.week_start)


def price_features(spec: PanelSpec = RETAIL) -> dict[str, Column]:
    return {
        "price_vs_competitor": price_vs_competitor(_q(spec.price), _q(spec.competitor_price)),
        "discount_pct": discount_pct(_q(spec.discount), _q(spec.price)),
    }


def lag_features(spec: PanelSpec = RETAIL, w: WindowSpec | None = None) -> dict[str, Column]:
    """Row-based lags of the target (null at the start of a series; gaps are not filled)."""
    w = series_window(spec) if w is None else w
    return {f"demand_lag_{k}": F.lag(_q(spec.target), k).over(w).cast("double") for k in spec.lags}


def rolling_features(spec: PanelSpec = RETAIL, w: WindowSpec | None = None) -> dict[str, Column]:
    """Mean and sample std of the previous ``n`` rows (current row excluded, nulls ignored,
    partial frames allowed; std needs two values)."""
    w = series_window(spec) if w is None else w
    out = {}
    for n in spec.windows:
        frame = w.rowsBetween(-n, -1)
        out[f"demand_roll_mean_{n}"] = F.avg(_q(spec.target)).over(frame)
        out[f"demand_roll_std_{n}"] = F.stddev_samp(_q(spec.target)).over(frame)
    return out


def feature_columns(spec: PanelSpec = RETAIL, w: WindowSpec | None = None) -> dict[str, Column]:
    cols = {}
    cols.update(price_features(spec))
    cols.update(calendar_features(spec))
    cols.update(lag_features(spec, w))
    cols.update(rolling_features(spec, w))
    return {name: cols[name] for name in spec.engineered}


def engineer_features(df: DataFrame, spec: PanelSpec = RETAIL, series_totals: DataFrame | None = None) -> DataFrame:
    """Append the 17 engineered columns (one Window node over the series).

    With ``spec.hot_series_rows`` set, series longer than that are cut into chunks first
    (see ``chunk_hot_series``) so no single task holds a hot series. ``series_totals``
    (rows per series, e.g. from the imputer fit) lets the check skip its counting pass.
    """
    if spec.hot_series_rows:
        return _chunked_features(df, spec, series_totals)
    return df.withColumns(feature_columns(spec, series_window(spec, columns=df.columns)))


# ---------------------------------------------------------------- hot series

_PART, _OWN, _HALO = "__series_part", "__series_chunk", "__series_halo"
#: Rows of one range partition when rows are placed exactly (more where chunks are longer).
RANGE_ROWS = 250_000


def _null_safe(left_cols, right_names) -> Column:
    cond = F.lit(True)
    for c, r in zip(left_cols, right_names):
        cond = cond & _q(c).eqNullSafe(F.col(r))
    return cond


def chunk_hot_series(df: DataFrame, spec: PanelSpec = RETAIL, series_totals: DataFrame | None = None) -> DataFrame | None:
    """Chunk assignment for the series with more than ``spec.hot_series_rows`` rows.

    Returns ``(keys..., date, chunk, halo)`` rows for hot series only (None when there are
    none). A chunk holds whole dates; ``halo`` lists the later chunks that need this
    date's rows as history, i.e. whose first row is within the date's rows plus the
    look-back (``spec.max_lookback``). Built from per-(series, date) counts -- metadata
    far smaller than the data, checkpointed once.
    """
    m = int(spec.hot_series_rows)
    look = spec.max_lookback
    names = list(spec.series_keys)
    keys = [_q(k) for k in names]
    d = _q(spec.date)
    src = df
    if series_totals is not None:
        # hot series are known from the fit's counts: at most (rows / m) of them
        hot_keys = series_totals.where(F.col("_total") > m).select(
            *[_q(k).alias(f"_h{i}") for i, k in enumerate(names)])
        n_hot = hot_keys.count()  # a job over the small totals table
        if n_hot == 0:
            return None
        if n_hot <= spec.broadcast_rows:
            hot_keys = F.broadcast(hot_keys)
        src = df.join(hot_keys, _null_safe(names, [f"_h{i}" for i in range(len(names))]), "left_semi")
    counts = src.groupBy(*keys, d).agg(F.count(F.lit(1)).alias("_n"))
    by_series = Window.partitionBy(*keys)
    ordered = by_series.orderBy(F.asc_nulls_first(spec.date))
    counts = counts.select(
        "*",
        F.coalesce(F.sum("_n").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"),
        F.sum("_n").over(by_series).alias("_total"),
    )
    hot = counts.where(F.col("_total") > m).withColumn("_chunk", F.floor(F.col("_start") / F.lit(m)))
    # A date lends its rows to a later chunk whose first row lies within the date's rows
    # plus the look-back. Every date holds at least one row, so only the next
    # ``look + 1`` dates can start such a chunk: a bounded frame, no pairing of dates.
    first = F.coalesce(F.lag("_chunk").over(ordered) != F.col("_chunk"), F.lit(True))
    hot = hot.withColumn("_first", first)
    ahead = F.collect_list(F.struct("_start", "_chunk", "_first")).over(ordered.rowsBetween(1, look + 1))
    reach = F.col("_start") + F.col("_n") + F.lit(look)
    halo = F.transform(
        F.filter(ahead, lambda x: x["_first"] & (x["_chunk"] != F.col("_chunk")) & (x["_start"] < reach)),
        lambda x: x["_chunk"],
    )
    hot = reliable_checkpoint(hot.select(*keys, d, "_n", "_chunk", halo.alias("_halo")))
    if hot.isEmpty():
        return None
    return hot


def _chunked_features(df: DataFrame, spec: PanelSpec, series_totals: DataFrame | None = None) -> DataFrame:
    assign = chunk_hot_series(df, spec, series_totals)
    if assign is None:
        return df.withColumns(feature_columns(spec, series_window(spec, columns=df.columns)))
    biggest_day, hot_rows = assign.agg(F.max("_n"), F.sum("_n")).first()
    if biggest_day * 2 > spec.hot_series_rows:
        # some (series, date) group -- e.g. many copies of one row -- is too big for
        # date-aligned chunks: place every hot row exactly and cut by row position
        hot_keys = assign.select(*[_q(k) for k in spec.series_keys]).distinct()
        return _row_exact_features(df, spec, hot_keys, int(hot_rows))
    names = list(spec.series_keys) + [spec.date]
    a = assign.select(*[_q(c).alias(f"_a{i}") for i, c in enumerate(names)],
                      F.col("_chunk").alias(_OWN), F.col("_halo").alias(_HALO))
    if a.count() <= spec.broadcast_rows:
        a = F.broadcast(a)
    cond = F.lit(True)
    for i, c in enumerate(names):
        cond = cond & _q(c).eqNullSafe(F.col(f"_a{i}"))
    joined = df.join(a, cond, "left").drop(*[f"_a{i}" for i in range(len(names))])
    own = F.coalesce(F.col(_OWN), F.lit(0)).cast("bigint")
    parts = F.array_union(F.array(own), F.coalesce(F.col(_HALO), F.array().cast("array<bigint>")).cast("array<bigint>"))
    rows = joined.select("*", F.explode(parts).alias(_PART))
    w = series_window(spec, partition_extra=(_PART,), columns=df.columns)
    out = rows.withColumns(feature_columns(spec, w))
    # halo copies only lend history to the next chunk: keep each row once, in its own chunk
    return out.where(F.col(_PART) == own).drop(_PART, _OWN, _HALO)


def _row_exact_features(df: DataFrame, spec: PanelSpec, hot_keys: DataFrame, total: int) -> DataFrame:
    """Features with hot series cut at exact row positions (any skew, copies included).

    Hot rows get their position in the series from a distributed rank: a range partition
    on the series order and a row id -- which splits only rows equal in every column -- checkpointed so partition ids are stable, numbered inside each
    partition, plus the counts of earlier partitions. The partitions hold RANGE_ROWS rows however
    short the chunks are, which are cut by position: their number grows with the rows alone. Chunks
    then hold exactly ``hot_series_rows`` rows, and each row is also lent to the chunks whose first
    ``max_lookback`` positions follow it. Cold series take the plain window.
    """
    m, look = int(spec.hot_series_rows), spec.max_lookback
    names = list(spec.series_keys)
    keys = [_q(k) for k in names]
    hk = hot_keys.select(*[_q(k).alias(f"_h{i}") for i, k in enumerate(names)])
    n_hot = hk.count()
    hk = F.broadcast(hk) if n_hot <= spec.broadcast_rows else hk
    cond = _null_safe(names, [f"_h{i}" for i in range(len(names))])
    cold = df.join(hk, cond, "left_anti").withColumns(feature_columns(spec, series_window(spec, columns=df.columns)))
    hot = df.join(hk, cond, "left_semi")
    order = series_order(spec, df.columns) + [F.asc("__row_id")]
    hot = hot.withColumn("__row_id", F.monotonically_increasing_id())
    parts = max(1, -(-total // max(m, RANGE_ROWS)))  # ``total``: hot rows, from the per-date counts
    ranged = hot.repartitionByRange(parts, *keys, *order).withColumn("__pid", F.spark_partition_id())
    ranged = reliable_checkpoint(ranged)
    local = Window.partitionBy("__pid", *keys).orderBy(*order)
    numbered = ranged.withColumn("__local", F.row_number().over(local) - 1)
    sizes = ranged.groupBy(*keys, "__pid").agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(*keys).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, "__pid", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__offset"))
    # one row per (hot series, range partition): bounded by the partition count
    placed = numbered.join(F.broadcast(offsets), names + ["__pid"]).withColumn(
        "__pos", F.col("__offset") + F.col("__local"))
    own = F.floor(F.col("__pos") / F.lit(m)).cast("bigint")
    last = F.floor((F.col("__pos") + F.lit(look)) / F.lit(m)).cast("bigint")
    lend = F.when(last > own, F.sequence(own + 1, last)).otherwise(F.array().cast("array<bigint>"))
    rows = placed.withColumn(_OWN, own).select("*", F.explode(F.concat(F.array(F.col(_OWN)), lend)).alias(_PART))
    w = Window.partitionBy(*keys, F.col(_PART)).orderBy("__pos")
    feats = rows.withColumns(feature_columns(spec, w)).where(F.col(_PART) == F.col(_OWN))
    helper = ["__row_id", "__pid", "__local", "__offset", "__pos", _OWN, _PART]
    return cold.unionByName(feats.drop(*helper))
