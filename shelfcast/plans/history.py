"""Features of forecast requests from the history of their series.

For each request the state of its series before the request date is looked up: the last targets and the
last row. From it come the serving features (codes, lag 1, lag 7, 7-row mean, price, promotion) or whole rows
of the 29-column training matrix. All forecast days of a request hold this state; only their calendar differs.

Requests of one series and date have one state: it is looked up, and turned into features, once for each different
(store, item, date), and joined to the requests, which are validated once.

The lookup pairs no requests with rows. Panel rows and the different requests are one sequence of events in order of
series and day, cut by range into chunks of bounded size wherever a series is long:

1. Within a chunk, bounded frames give every row's last targets, and a running last hands the latest row's to the
   requests that follow it in the chunk.
2. Each chunk leaves one summary a series: its last targets and last row. Summaries are scanned in
   order (a chunk may hold fewer rows than are looked back), which gives the state before each chunk.
3. A request's state is the carried one followed by what its chunk has before it.

So no task goes through a whole series, however large its share of all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.calendar import calendar_columns
from shelfcast.operators.encode import LabelModel, apply_labels
from shelfcast.operators.features import price_features
from shelfcast.operators.impute import ImputerStats
from shelfcast.plans.scoring import REQUEST_COLS, SERVING_PLACEHOLDERS
from shelfcast.session import reliable_checkpoint, staged
from shelfcast.spec import RETAIL, PanelSpec

STATE = ("lag_1_sales", "lag_7_sales", "rolling_mean_7", "price", "promo")
CODES = ("store_id_encoded", "item_id_encoded")
#: Request features that history replaces; the calendar comes from the forecast day.
KNOWN = CODES + STATE
#: Events (panel rows and requests) of one chunk.
CHUNK_ROWS = 1_000_000
#: Value of a lag or rolling feature whose series has too few rows.
NO_HISTORY = 0.0
_SERIES = ["k0", "k1"]
#: What a request's state depends on.
ASKED = ("store_id", "item_id", "date")


def _events(asked: DataFrame, history: DataFrame, spec: PanelSpec) -> DataFrame:
    """k0, k1, d, side (0: request, 1: row), o (the order of rows of one day), y, last (the row)."""
    day = (spec.date, *spec.tie_breakers)
    rest = [c for c in history.columns if c not in (*day, *spec.series_keys)]
    order = F.struct(*[F.col(f"`{c}`").alias(f"o{i}") for i, c in enumerate((*spec.tie_breakers, *rest))])
    known = F.struct(*[F.col(f"`{c}`") for c in rest])
    rows = history.select(*[F.col(f"`{k}`").cast("string").alias(a) for k, a in zip(spec.series_keys, _SERIES)], F.col(f"`{spec.date}`").alias("d"),
                          F.lit(1).alias("side"), order.alias("o"), F.col(f"`{spec.target}`").cast("double").alias("y"), known.alias("last"))
    empty = lambda c: F.lit(None).cast(rows.schema[c].dataType).alias(c)
    # requests come before the rows of their own day, so only earlier days count
    return rows.unionAll(asked.select(*[F.col(c).alias(a) for c, a in zip(ASKED, (*_SERIES, "d"))], F.lit(0).alias("side"),
                                      empty("o"), empty("y"), empty("last")))


def _to_requests(requests: DataFrame, states: DataFrame) -> DataFrame:
    """Request columns and the other columns of ``states`` (one row for each different ASKED) for every request."""
    named = states.select(*[F.col(c).alias(f"_{c}") for c in ASKED], *[F.col(f"`{c}`") for c in states.columns if c not in ASKED])
    same = (F.col("store_id") == F.col("_store_id")) & (F.col("item_id") == F.col("_item_id")) & F.col("date").eqNullSafe(F.col("_date"))
    return requests.select(*REQUEST_COLS).join(named, same).drop(*[f"_{c}" for c in ASKED])


def last_state(requests: DataFrame, history: DataFrame, spec: PanelSpec = RETAIL, look: int | None = None,
               chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Request columns, ``recent`` (up to ``look`` targets before the request date, oldest first) and ``last`` (the
    latest row's other columns; null without an earlier dated row) for every row of ``requests``."""
    return _to_requests(requests, asked_states(requests, history, spec, look, chunk_rows))


def asked_states(requests: DataFrame, history: DataFrame, spec: PanelSpec = RETAIL, look: int | None = None,
                 chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """ASKED, ``recent`` and ``last`` (see ``last_state``), one row for each different ASKED of ``requests``."""
    look = look or spec.max_lookback
    asked = staged(requests.select(*ASKED).distinct(), "asked")
    events = _events(asked, history, spec).withColumn("rid", F.monotonically_increasing_id())
    parts = max(1, -(-(history.count() + asked.count()) // chunk_rows))
    # the row id splits even identical rows; written, so that chunk numbers are stable
    order = [F.col("d").asc_nulls_first(), F.col("side"), F.col("o").asc_nulls_first(), F.col("rid")]
    cut = reliable_checkpoint(events.repartitionByRange(parts, *_SERIES, *order).withColumn("chunk", F.spark_partition_id()))

    own = Window.partitionBy("chunk", *_SERIES)
    frame = Window.partitionBy("chunk", *_SERIES, "side").orderBy(*order).rowsBetween(1 - look, 0)
    # ``dated``: rows without a date come first in their series and are history to later rows, but no state of their own
    state = F.when(F.col("side") == 1, F.struct(F.col("recent"), F.col("last"), F.col("d").isNotNull().alias("dated")))
    # requests gather nothing: their frames hold nulls, which a list leaves out
    target = F.when(F.col("side") == 1, F.struct("y"))
    held = cut.repartition("chunk", *_SERIES).withColumn("recent", F.collect_list(target).over(frame)).withColumn("state", state)
    here = held.withColumn("here", F.last("state", ignorenulls=True).over(own.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))

    # one summary a chunk and series, null where the chunk has requests alone
    ends = held.groupBy("chunk", *_SERIES).agg(F.max_by("state", F.when(F.col("side") == 1, F.struct("d", "side", "o", "rid"))).alias("s"))
    ends = reliable_checkpoint(ends)
    tails = ends.where(F.col("s").isNotNull()).select("chunk", *_SERIES, F.posexplode("s.recent").alias("i", "y"), F.size("s.recent").alias("n"),
                                                     F.col("s.last").alias("last"), F.col("s.dated").alias("dated"))
    scan = Window.partitionBy(*_SERIES).orderBy("chunk", "i").rowsBetween(1 - look, 0)
    after = (tails.withColumn("recent", F.collect_list("y").over(scan)).where(F.col("i") == F.col("n") - 1)
             .select("chunk", *_SERIES, F.struct("recent", "last", "dated").alias("after")))
    before = Window.partitionBy(*_SERIES).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = (ends.select("chunk", *_SERIES).join(after, ["chunk", *_SERIES], "left")
               .withColumn("carry", F.last("after", ignorenulls=True).over(before)).select("chunk", *_SERIES, "carry"))

    none = F.array().cast(held.schema["recent"].dataType)
    found = here.where("side = 0").join(carried, ["chunk", *_SERIES])
    every = F.concat(F.coalesce("carry.recent", none), F.coalesce("here.recent", none))
    recent = F.transform(F.slice(every, F.greatest(F.size(every) - look + 1, F.lit(1)), look), lambda x: x["y"])
    latest = F.coalesce("here", "carry")
    dated = F.coalesce(latest["dated"], F.lit(False))
    return found.select(*[F.col(a).alias(c) for c, a in zip(ASKED, (*_SERIES, "d"))], F.when(dated, recent).otherwise(F.array().cast("array<double>")).alias("recent"),
                        F.when(dated, latest["last"]).alias("last"))


def _back(k: int) -> Column:
    """The k-th target from the end; null where there are fewer."""
    return F.when(F.size("recent") >= k, F.element_at("recent", -k))


def _with_spreads(found: DataFrame, windows) -> DataFrame:
    """``_mean_n`` and ``_std_n`` of the last ``n`` targets (sample standard deviation, nulls ignored) for each n of
    ``windows``. In steps, so that a mean is summed once and not once for each target of its spread."""
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, v: s + v)
    x, size, mean = (lambda n, p=p: F.col(f"_{p}_{n}") for p in ("x", "size", "mean"))
    last = lambda n: F.slice("recent", F.greatest(F.size("recent") - n + 1, F.lit(1)), n)
    found = found.withColumns({f"_x_{n}": F.filter(last(n), lambda v: v.isNotNull()) for n in windows})
    found = found.withColumns({f"_size_{n}": F.size(x(n)) for n in windows})
    found = found.withColumns({f"_mean_{n}": F.when(size(n) > 0, total(x(n)) / F.greatest(size(n), F.lit(1))) for n in windows})
    squares = lambda n: F.transform(x(n), lambda v: (v - mean(n)) * (v - mean(n)))
    return found.withColumns({f"_std_{n}": F.when(size(n) > 1, F.sqrt(total(squares(n)) / F.greatest(size(n) - 1, F.lit(1)))) for n in windows})


def attach_history(validated: DataFrame, history: DataFrame, labels: LabelModel, spec: PanelSpec = RETAIL,
                   promotion: str = "Promotion", chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Validated requests with the KNOWN features. Placeholders stand where a series has no earlier
    row (or fewer than seven, for lag 7); an unseen store or item gets the extra code; rejected
    requests have nulls."""
    requests = staged(validated.select(*REQUEST_COLS), "requests")
    valid = requests.where(F.col("status").isNull())
    found = _with_spreads(asked_states(valid, history, spec, 7, chunk_rows), (7,))
    for name, column, key in zip(CODES, spec.series_keys, ("store_id", "item_id")):
        codes = labels.labels.where(F.col("column") == column).select(F.col("value").alias("_v"), F.col("index").alias("_i"))
        n = labels.sizes.get(column, 0)
        codes = F.broadcast(codes) if labels.small(column) else codes
        found = (found.join(codes, F.col(key) == F.col("_v"), "left")
                 .withColumn(name, F.coalesce(F.col("_i"), F.lit(n)).cast("double")).drop("_v", "_i"))
    values = (_back(1), _back(7), F.col("_mean_7"), F.col("last")[spec.price], F.col("last")[promotion])
    known = [F.coalesce(v.cast("double"), F.lit(SERVING_PLACEHOLDERS[s])).alias(s) for s, v in zip(STATE, values)]
    rejected = requests.where(F.col("status").isNotNull()).select("*", *[F.lit(None).cast("double").alias(k) for k in KNOWN])
    return _to_requests(valid, found.select(*ASKED, *CODES, *known)).unionByName(rejected)


# ------------------------------------------------------------ rows of the training matrix

def matrix_known(spec: PanelSpec = RETAIL) -> tuple[str, ...]:
    """The matrix features that all forecast days of a request share: all but the calendar."""
    return tuple(c for c in spec.output_cols[1:] if c not in spec.calendar_cols)


def attach_matrix_features(validated: DataFrame, history: DataFrame, imputer: ImputerStats, labels: LabelModel,
                           spec: PanelSpec = RETAIL, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Validated requests with every feature of the training matrix but the calendar, from a frozen fit.

    Store and item are the request's; the other categoricals and the numerics are those of the series' latest row, or
    the imputer's modes and medians without one; all categoricals become the fitted codes, unseen ones the
    extra code. Lags and rolling features count back from the latest row; where the series is too short they
    are NO_HISTORY. Rejected requests have nulls.
    """
    requests = staged(validated.select(*REQUEST_COLS), "requests")
    valid = requests.where(F.col("status").isNull())
    found = _with_spreads(asked_states(valid, history, spec, spec.max_lookback, chunk_rows), spec.windows)
    columns = {k: F.col(c) for k, c in zip(spec.series_keys, ("store_id", "item_id"))}
    columns |= {c: F.coalesce(F.col("last")[c], F.lit(imputer.modes[c])) for c in spec.categoricals if c not in spec.series_keys}
    columns |= {c: F.coalesce(F.col("last")[c], F.lit(imputer.medians[c])) for c in spec.numerics}
    lagged = {f"demand_lag_{k}": _back(k) for k in spec.lags}
    for n in spec.windows:
        lagged[f"demand_roll_mean_{n}"], lagged[f"demand_roll_std_{n}"] = F.col(f"_mean_{n}"), F.col(f"_std_{n}")
    columns |= {name: F.coalesce(v, F.lit(NO_HISTORY)) for name, v in lagged.items()}
    rows = found.select(*ASKED, *[v.alias(k) for k, v in columns.items()])
    rows = apply_labels(rows.withColumns(price_features(spec)), labels)
    known = [F.col(f"`{c}`") for c in matrix_known(spec)]
    rejected = requests.where(F.col("status").isNotNull()).select("*", *[F.lit(None).cast("double").alias(c) for c in matrix_known(spec)])
    return _to_requests(valid, rows.select(*ASKED, *[c.cast("double") for c in known])).unionByName(rejected)


def matrix_day_features(days: DataFrame, spec: PanelSpec = RETAIL) -> DataFrame:
    """Day rows with the calendar features of their forecast date: now all of the matrix's."""
    return days.withColumns(calendar_columns(F.col("forecast_date"), spec.week_start))
