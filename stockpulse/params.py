"""Run parameters (forecast horizon, risk thresholds, model settings)."""

from __future__ import annotations

from dataclasses import dataclass, field

# Fixed values that must equal the original application's defaults.
DEFAULT_HORIZON_WEEKS = 8
DEFAULT_SEASONAL_LAG_WEEKS = 52
DEFAULT_STOCKOUT_THRESHOLD = 0.55
DEFAULT_OVERSTOCK_THRESHOLD = 0.55
DEFAULT_SAFETY_STOCK_MULTIPLIER = 1.15
DEFAULT_RIDGE_ALPHA = 2.5
DEFAULT_ONE_HOT_MIN_FREQUENCY = 5
LAGS = (1, 2, 4, 8, 13, 26, 52)


@dataclass(frozen=True)
class Params:
    horizon_weeks: int = DEFAULT_HORIZON_WEEKS
    seasonal_lag_weeks: int = DEFAULT_SEASONAL_LAG_WEEKS
    stockout_threshold: float = DEFAULT_STOCKOUT_THRESHOLD
    overstock_threshold: float = DEFAULT_OVERSTOCK_THRESHOLD
    safety_stock_multiplier: float = DEFAULT_SAFETY_STOCK_MULTIPLIER
    ridge_alpha: float = DEFAULT_RIDGE_ALPHA
    one_hot_min_frequency: int = DEFAULT_ONE_HOT_MIN_FREQUENCY
    # "sku": back fill of inventory stays inside one SKU (default).
    # "global": a SKU without any snapshot borrows the next SKU's first
    # snapshot, as the original un-grouped back fill did.
    fill_scope: str = "sku"
    # SKU grain of the driver-table adapter: "brand_type" or "part".
    grain: str = "brand_type"
    lags: tuple = field(default=LAGS)
