"""Fit-time statistics: medians, modes and value counts.

All columns are handled together in *long* form ``(name, value)``: one scan, one
shuffle, partial aggregation before the shuffle (a value held by a third of all rows
costs one row per map task). Only per-column scalars ever reach the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.spec import MEDIAN_RELATIVE_ERROR, UNKNOWN_CATEGORY


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _no_nan(c: Column) -> Column:
    """Null for NaN so quantiles ignore it (as ``approxQuantile`` does)."""
    return F.when(~F.isnan(c), c)


def to_long(df: DataFrame, cols, value_type: str | None = None) -> DataFrame:
    """Unpivot ``cols`` to rows ``(name, value)`` with one generator, no extra scans."""
    def val(c):
        v = _q(c)
        return v.cast(value_type) if value_type else v

    pairs = F.array(*[F.struct(F.lit(c).alias("name"), val(c).alias("value")) for c in cols])
    return df.select(F.inline(pairs))


# ---------------------------------------------------------------- medians

#: Cells a column that one selection pass counts.
CELLS = 1 << 16
#: Cells of one power of two in the first pass.
_SUB = 16


def _first_cell(v: Column) -> Column:
    """Cell of a value in the first pass: sign, power of two and a sixteenth of it. Never falls as
    the value grows (rounding at a power's edge moves whole neighbourhoods)."""
    a = F.abs(v)
    power = F.floor(F.log2(a))
    part = F.least(F.greatest(F.floor((a / F.pow(F.lit(2.0), power) - 1) * _SUB), F.lit(0)), F.lit(_SUB - 1))
    cell = F.when(a == 0, 0).when(a == float("inf"), 2200 * _SUB).otherwise((power + 1100) * _SUB + part)
    return F.when(v < 0, -cell).otherwise(cell).cast("int")


def _next_cell(v: Column, lo: float, hi: float) -> Column:
    """Cell of a value of ``[lo, hi]`` in a later pass, null for one outside: equal steps from lo to hi."""
    cell = F.least(F.floor((v - F.lit(lo)) / F.lit(hi - lo) * CELLS), F.lit(CELLS - 1))
    return F.when((v >= F.lit(lo)) & (v <= F.lit(hi)), cell).cast("int")


def select_quantile(df: DataFrame, cols, fraction: float = 0.5, relative_error: float = 0.0) -> dict[str, float]:
    """The ceil(fraction * N)-th smallest value per column by radix selection, null and NaN ignored;
    all-null -> 0.0.

    The first pass counts every column's values by sign, power of two and sixteenth, each later one by
    CELLS equal steps of the range that is left, and only the cell that holds the wanted rank goes
    on. Cells never fall as values grow, so ranks are exact. A cell of the first pass spans at most
    2**48 doubles of one power of two and every later pass divides that by 2**16, so four passes suffice;
    a column is done as soon as its cell holds one value. A pass is one aggregation with at most
    CELLS rows a column, summed up before the shuffle; values are neither shuffled nor kept.

    With ``relative_error`` a column is also done when its cell holds at most that share of its values; the
    answer is then the cell's least value, whose rank is off by less than that, guaranteed. Either way the
    same table gives the same answer, however it is split.
    """
    cols = list(cols)
    result, open_, span, wanted, total = dict.fromkeys(cols, 0.0), cols, {}, {}, {}
    while open_:
        entries = []
        for c in open_:
            v = _q(c).cast("double") + F.lit(0.0)  # -0.0 is 0.0
            cell = F.when(~F.isnan(v), _first_cell(v)) if c not in span else _next_cell(v, *span[c])
            entries.append(F.struct(F.lit(c).alias("name"), v.alias("value"), cell.alias("cell")))
        cells = (df.select(F.inline(F.array(*entries))).where(F.col("cell").isNotNull()).groupBy("name", "cell")
                 .agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")))
        by_name = Window.partitionBy("name")  # at most 2 * 2200 * 16 or CELLS rows a column
        ranked = cells.withColumn("upto", F.sum("n").over(by_name.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)))
        known = F.create_map(*[x for c in wanted for x in (F.lit(c), F.lit(wanted[c]))])[F.col("name")] if wanted else None
        rank = F.ceil(F.lit(fraction) * F.sum("n").over(by_name)) if known is None else known
        ranked = ranked.withColumn("rank", F.greatest(rank, F.lit(1)).cast("long")).withColumn("all", F.sum("n").over(by_name))
        held = {r["name"]: r for r in ranked.where((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("n") < F.col("rank"))).collect()}
        still = []
        for c in open_:
            r = held.get(c)
            if r is None:  # no value at all
                continue
            total.setdefault(c, r["all"])
            if r["lo"] == r["hi"] or r["n"] <= relative_error * total[c]:
                result[c] = float(r["lo"])
                continue
            span[c], wanted[c] = (r["lo"], r["hi"]), r["rank"] - (r["upto"] - r["n"])
            still.append(c)
        wanted = {c: wanted[c] for c in still}
        open_ = still
    return result


def approx_medians(df: DataFrame, cols, relative_error: float = MEDIAN_RELATIVE_ERROR) -> dict[str, float]:
    """Lower medians whose rank is off by less than ``relative_error`` of a column's values, guaranteed and
    the same on every run; all-null -> 0.0."""
    return select_quantile(df, cols, 0.5, relative_error)


def exact_medians(df: DataFrame, cols) -> dict[str, float]:
    """Exact lower median (the ceil(N/2)-th smallest value) per column; all-null -> 0.0."""
    return select_quantile(df, cols)


def medians(df: DataFrame, cols, method: str = "exact", relative_error: float = MEDIAN_RELATIVE_ERROR) -> dict[str, float]:
    if method == "approx":
        return approx_medians(df, cols, relative_error)
    if method == "exact":
        return exact_medians(df, cols)
    raise ValueError(f"median method must be 'approx' or 'exact', got {method!r}")


# ---------------------------------------------------------------- modes

SERIES_ENTRY = "__series__"


def category_counts(df: DataFrame, cols, series_keys=()) -> DataFrame:
    """``(name, value, n)``: row count of every value (null included) of every column.

    With ``series_keys``, the same aggregation also counts rows per series (name
    ``__series__``, value = JSON of the key tuple), which the feature step uses to find
    hot series without another pass over the data.
    """
    entries = [F.struct(F.lit(c).alias("name"), _q(c).cast("string").alias("value")) for c in cols]
    if series_keys:
        key = F.to_json(F.struct(*[_q(k).alias(f"k{i}") for i, k in enumerate(series_keys)]))
        entries.append(F.struct(F.lit(SERIES_ENTRY).alias("name"), key.alias("value")))
    return df.select(F.inline(F.array(*entries))).groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))


def modes_from_counts(counts: DataFrame, unknown: str = UNKNOWN_CATEGORY) -> DataFrame:
    """Rows ``(column, mode)`` from ``category_counts``: most frequent non-null value,
    ties -> smallest value, all-null -> ``unknown``."""
    best = counts.where(F.col("name") != SERIES_ENTRY).groupBy("name").agg(
        F.min(F.struct(F.col("value").isNull().alias("is_null"), (-F.col("n")).alias("neg_n"), F.col("value").alias("v"))).alias("b")
    )
    return best.select(
        F.col("name").alias("column"),
        F.coalesce(F.col("b.v"), F.lit(unknown)).alias("mode"),
    )


def modes_frame(df: DataFrame, cols, unknown: str = UNKNOWN_CATEGORY) -> DataFrame:
    """Rows ``(column, mode)``. Two aggregation levels, both partial before the shuffle."""
    return modes_from_counts(category_counts(df, cols), unknown)


#: Values a column's frequent-item summary tracks, and candidates that are counted exactly.
TRACKED, CANDIDATES = 10_000, 64


def frequent_modes(df: DataFrame, cols) -> dict[str, str]:
    """Modes of the columns whose most frequent value is provably found by a bounded summary; others are left out.

    One aggregate of mergeable summaries (at most TRACKED values a column and task) names up to CANDIDATES
    frequent values, a second pass counts just those exactly. A value that is not named has at most
    7 / TRACKED of the column's values (twice the summary's error of 3.5 / TRACKED), or at most
    the last name's estimate if the list is full. The best count is the mode's if it exceeds that bound, so the answer is
    exact, ties included, and no distinct value but the candidates is shuffled.
    """
    cols = list(cols)
    parts = [x for i, c in enumerate(cols) for x in (F.expr(f"approx_top_k(cast(`{c}` as string), {CANDIDATES}, {TRACKED})").alias(f"k{i}"),
                                                     F.count(_q(c)).alias(f"n{i}"))]
    found = df.agg(*parts).first()
    named = {c: {r["item"]: r["count"] for r in found[f"k{i}"] or () if r["item"] is not None} for i, c in enumerate(cols)}
    asked = [c for c in cols if named[c]]
    if not asked:
        return {}
    entries = [F.struct(F.lit(c).alias("name"), F.when(_q(c).cast("string").isin(*named[c]), _q(c).cast("string")).alias("value")) for c in asked]
    counts = (df.select(F.inline(F.array(*entries))).where(F.col("value").isNotNull()).groupBy("name", "value")
              .agg(F.count(F.lit(1)).alias("n")).collect())
    out = {}
    for i, c in enumerate(cols):
        exact = [(-r["n"], r["value"]) for r in counts if r["name"] == c]
        bound = max(7 * found[f"n{i}"] / TRACKED, min(named[c].values()) if len(named[c]) == CANDIDATES else 0)
        if exact and -min(exact)[0] > bound:
            out[c] = min(exact)[1]
    return out


def modes(df: DataFrame, cols, unknown: str = UNKNOWN_CATEGORY) -> dict[str, str]:
    """Most frequent non-null value per column, ties -> smallest, all-null -> ``unknown``. Columns without a provably
    frequent value (many values of about equal count) are counted value by value."""
    cols = list(cols)
    out = frequent_modes(df, cols) if cols else {}
    rest = [c for c in cols if c not in out]
    return {**out, **collect_modes(modes_frame(df, rest, unknown), rest, unknown)} if rest else out


def collect_modes(frame: DataFrame, cols, unknown: str = UNKNOWN_CATEGORY) -> dict[str, str]:
    found = {r["column"]: r["mode"] for r in frame.collect()}
    return {c: found.get(c, unknown) for c in cols}


def series_totals(counts: DataFrame, df_schema, series_keys, fill: dict) -> DataFrame:
    """Rows per series *after* null keys are filled with ``fill`` (their modes), from the
    ``__series__`` entries of ``category_counts`` -- a small table, no pass over the data."""
    fields = ", ".join(f"k{i} {df_schema[k].dataType.simpleString()}" for i, k in enumerate(series_keys))
    parsed = counts.where(F.col("name") == SERIES_ENTRY).select(
        F.from_json("value", f"struct<{fields}>").alias("k"), "n")
    keys = []
    for i, k in enumerate(series_keys):
        c = F.col(f"k.k{i}")
        if k in fill:
            c = F.coalesce(c, F.lit(fill[k]).cast(df_schema[k].dataType))
        keys.append(c.alias(k))
    return parsed.groupBy(*keys).agg(F.sum("n").alias("_total"))


# ---------------------------------------------------------------- value counts

def value_counts(df: DataFrame, col: str) -> DataFrame:
    """``(value, count)`` ordered by count descending, then value."""
    return (
        df.groupBy(_q(col).alias(col))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), F.asc_nulls_first(col))
    )
