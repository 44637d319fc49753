"""Parameters of the price analytics library.

Every domain constant lives in one frozen dataclass so that callers can
override any of them per call (``dataclasses.replace(DEFAULT, ...)``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Product codes, area label, thresholds and default parameters
# that results must agree with.  Product codes of the weekly retail price
# series; the ingested set, the national gold set, and the regional /
# forecast set, in this order of appearance.
INGEST_PRODUCTS = ("EPM0", "EPMR", "EPMP", "EPD2D", "EPD2DXL0")
NATIONAL_PRODUCTS = ("EPMR", "EPD2DXL0", "EPM0", "EPMP")
REGIONAL_PRODUCTS = ("EPMR", "EPD2DXL0")
FORECAST_PRODUCTS = ("EPMR", "EPD2DXL0")
DIESEL_PRODUCT = "EPD2DXL0"
DIESEL_PREFIX = "EPD"
NATIONAL_AREA = "U.S."
# Snapshot card slots: (slot code, keyword searched in the product name).
SNAPSHOT_SLOTS = (
    ("EPMR", "Regular"),
    ("EPD2DXL0", "Low Sulfur"),
    ("EPM0", "Total"),
    ("EPMP", "Premium"),
)
# Margin status thresholds in percent: above 25 healthy, above 15 watch,
# above 5 warning, otherwise critical.
MARGIN_HEALTHY = 25.0
MARGIN_WATCH = 15.0
MARGIN_WARNING = 5.0
# Recovery bands in percent: at least 100 good, at least 70 partial.
RECOVERY_GOOD = 100.0
RECOVERY_PARTIAL = 70.0
# Fleet assumptions used by the surcharge what-if.
FLEET_WEEKLY_DELIVERIES = 5410
FLEET_MILES_PER_DELIVERY = 39
FLEET_MPG = 6.2
SURCHARGE_STEP = 0.10
DEFAULT_MEAN_PRICE = 5.50
# Stored surcharge configuration row and the interactive defaults.
STORED_BASELINE = 4.50
STORED_RATE = 0.08
STORED_MODEL = "per $0.10 above baseline"
STORED_CALIBRATED = "2026-01-15"
UI_BASELINE = 4.50
UI_RATE = 0.35
# Slider grids, in integer hundredths: rate 0.00..1.00 step 0.01,
# baseline 3.00..6.00 step 0.05.
RATE_GRID_CENTS = (0, 100, 1)
BASELINE_GRID_CENTS = (300, 600, 5)
# baselines of the registered what-if grids (see plans/registry.py)
TEST_BASELINE_GRID_CENTS = (50, 300, 5)
PAGE_SIZE = 5000
# loads of the registered load report: page size, pages of a load
TEST_LOAD_PAGE_SIZE, TEST_PAGES_PER_LOAD = 500, 4
HORIZON_WEEKS = 8
MAX_TREND_WEEKS = 520
DEFAULT_TREND_WEEKS = 52
FORECAST_WINDOW_DAYS = 180
FORECAST_RECENT_DAYS = 90
PREVIEW_ROWS = 20
CHANGEPOINT_PRIOR = 0.05


@dataclass(frozen=True)
class Fleet:
    """Fleet parameters of the surcharge arithmetic."""

    weekly_deliveries: float = FLEET_WEEKLY_DELIVERIES
    miles_per_delivery: float = FLEET_MILES_PER_DELIVERY
    mpg: float = FLEET_MPG

    @property
    def gallons_per_delivery(self) -> float:
        return self.miles_per_delivery / self.mpg


@dataclass(frozen=True)
class Config:
    """All tunable parameters; pass a modified copy to override."""

    ingest_products: tuple[str, ...] = INGEST_PRODUCTS
    national_products: tuple[str, ...] = NATIONAL_PRODUCTS
    regional_products: tuple[str, ...] = REGIONAL_PRODUCTS
    forecast_products: tuple[str, ...] = FORECAST_PRODUCTS
    diesel_product: str = DIESEL_PRODUCT
    diesel_prefix: str = DIESEL_PREFIX
    national_area: str = NATIONAL_AREA
    snapshot_slots: tuple[tuple[str, str], ...] = SNAPSHOT_SLOTS
    page_size: int = PAGE_SIZE
    horizon_weeks: int = HORIZON_WEEKS
    forecast_weekday: str = "Sun"
    max_trend_weeks: int = MAX_TREND_WEEKS
    fleet: Fleet = field(default_factory=Fleet)
    source_tag: str = "price_api_v2"
    catalog: str = ""  # optional name prefix for the layer databases

    def database(self, layer: str) -> str:
        return f"{self.catalog}_{layer}" if self.catalog else layer

    def table(self, layer: str, name: str) -> str:
        return f"{self.database(layer)}.{name}"


DEFAULT = Config()
