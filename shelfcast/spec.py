"""Column layout of a daily store-by-product demand panel.

Every operator takes a ``PanelSpec`` so nothing is tied to one set of column
names; ``RETAIL`` is the layout of the raw retail CSV.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# --- Fixed values: names and order of the retail panel and of the model matrix.
# These must stay exactly as written so the output matrix has the expected layout.
LEAKY_COLS = ("Units Sold", "Units Ordered")
CATEGORICAL_COLS = ("Store ID", "Product ID", "Category", "Region", "Weather Condition", "Seasonality")
RAW_NUMERIC_COLS = ("Inventory Level", "Price", "Discount", "Promotion", "Competitor Pricing", "Epidemic")
TARGET_COL = "Demand"
DATE_COL = "Date"
PRICE_COL = "Price"
COMPETITOR_PRICE_COL = "Competitor Pricing"
DISCOUNT_COL = "Discount"
RAW_COLUMN_ORDER = (
    "Date", "Store ID", "Product ID", "Category", "Region", "Inventory Level", "Units Sold",
    "Units Ordered", "Price", "Discount", "Weather Condition", "Promotion", "Competitor Pricing",
    "Seasonality", "Epidemic", "Demand",
)
LAGS = (1, 7, 14, 28)
ROLLING_WINDOWS = (7, 30)
DEFAULT_CUTOFF = "2024-01-01"
UNKNOWN_CATEGORY = "UNKNOWN"
MEDIAN_RELATIVE_ERROR = 0.001
# --- end of fixed values


@dataclass(frozen=True)
class PanelSpec:
    date: str = DATE_COL
    series_keys: tuple[str, ...] = ("Store ID", "Product ID")
    categoricals: tuple[str, ...] = CATEGORICAL_COLS
    numerics: tuple[str, ...] = RAW_NUMERIC_COLS
    target: str = TARGET_COL
    leaky: tuple[str, ...] = LEAKY_COLS
    lags: tuple[int, ...] = LAGS
    windows: tuple[int, ...] = ROLLING_WINDOWS
    price: str = PRICE_COL
    competitor_price: str = COMPETITOR_PRICE_COL
    discount: str = DISCOUNT_COL
    cutoff: str = DEFAULT_CUTOFF
    # "monday0" (Mon=0 .. Sun=6, weekend = Sat+Sun) or "sunday0" (Sun=0 .. Sat=6,
    # weekend = Fri+Sat, what ``dayofweek - 1`` gives).
    week_start: str = "monday0"
    # Extra order columns that break ties between rows of one series on one date.
    tie_breakers: tuple[str, ...] = field(default_factory=tuple)
    # Series with more rows than this are cut into chunks (with a look-back halo) before
    # the window, so one hot series never lands in one task. None: plain window.
    hot_series_rows: int | None = 2_000_000
    # Largest metadata table (rows) that is broadcast; larger ones are shuffle-joined.
    broadcast_rows: int = 2_000_000

    def with_(self, **kw) -> "PanelSpec":
        return replace(self, **kw)

    @property
    def typed_numerics(self) -> tuple[str, ...]:
        """Columns cast to double and imputed with medians (target included)."""
        return self.numerics + (self.target,)

    @property
    def calendar_cols(self) -> tuple[str, ...]:
        return ("day_of_week", "day_of_month", "week_of_year", "month", "quarter", "year", "is_weekend")

    @property
    def lag_cols(self) -> tuple[str, ...]:
        return tuple(f"demand_lag_{k}" for k in self.lags)

    @property
    def rolling_cols(self) -> tuple[str, ...]:
        out = []
        for n in self.windows:
            out += [f"demand_roll_mean_{n}", f"demand_roll_std_{n}"]
        return tuple(out)

    @property
    def engineered(self) -> tuple[str, ...]:
        return ("price_vs_competitor", "discount_pct") + self.calendar_cols + self.lag_cols + self.rolling_cols

    @property
    def required(self) -> tuple[str, ...]:
        """Columns that must be non-null (and not NaN) for a row to be trainable."""
        return self.categoricals + self.numerics + self.engineered + (self.target,)

    @property
    def output_cols(self) -> tuple[str, ...]:
        """Model matrix order: target first, then categoricals, raw numerics, engineered."""
        return (self.target,) + self.categoricals + self.numerics + self.engineered

    @property
    def max_lookback(self) -> int:
        return max(max(self.lags, default=0), max(self.windows, default=0))


RETAIL = PanelSpec()
