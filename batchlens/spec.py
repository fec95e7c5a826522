"""Table specifications: every operator takes one of these instead of fixed column names."""

from __future__ import annotations

from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Bound:
    column: str
    lo: float
    hi: float


@dataclass(frozen=True)
class TableSpec:
    """Column roles of a trip-like event table.

    ``raw_features`` is ordered (the model feature order); ``categorical`` is the subset treated as
    categories. Optional roles (distance, passengers, coordinates) may be absent; the operators then
    skip the checks that need them, as the reference skips checks for absent columns.
    """

    event_ts: str
    end_ts: str
    target: str
    raw_features: tuple[str, ...]
    categorical: tuple[str, ...]
    distance: str | None = None
    passengers: str | None = None
    coordinates: tuple[Bound, ...] = ()
    banned: tuple[str, ...] = ()
    renames: tuple[tuple[str, str], ...] = ()
    hour_col: str = "pickup_hour"
    weekday_col: str = "pickup_weekday"
    month_col: str = "pickup_month"
    duration_col: str = "trip_duration_min"
    distance_q: float = 0.99
    target_q: float = 0.99
    duration_q: float = 0.99
    batch_freq: str = "week"
    min_batch_rows: int = 100
    batch_col: str = "batch_start"
    extra: dict = field(default_factory=dict, compare=False, hash=False)

    @property
    def generated(self) -> tuple[str, ...]:
        return (self.hour_col, self.weekday_col, self.month_col, self.duration_col)

    @property
    def features(self) -> tuple[str, ...]:
        return tuple(self.raw_features) + self.generated

    @property
    def numerical(self) -> tuple[str, ...]:
        return tuple(c for c in self.features if c not in self.categorical)

    @property
    def required(self) -> tuple[str, ...]:
        return (self.event_ts, self.end_ts, self.target, *self.raw_features)

    def with_(self, **kw) -> "TableSpec":
        return replace(self, **kw)


# Fixed values of the taxi layout the reference is configured for (column names, thresholds,
# coordinate bounds, the one column alias it accepts).
TAXI = TableSpec(
    event_ts="tpep_pickup_datetime",
    end_ts="tpep_dropoff_datetime",
    target="total_amount",
    raw_features=(
        "VendorID",
        "passenger_count",
        "trip_distance",
        "pickup_longitude",
        "pickup_latitude",
        "RatecodeID",
        "store_and_fwd_flag",
        "dropoff_longitude",
        "dropoff_latitude",
    ),
    categorical=("VendorID", "RatecodeID", "store_and_fwd_flag"),
    distance="trip_distance",
    passengers="passenger_count",
    coordinates=(
        Bound("pickup_longitude", -180.0, 180.0),
        Bound("dropoff_longitude", -180.0, 180.0),
        Bound("pickup_latitude", -90.0, 90.0),
        Bound("dropoff_latitude", -90.0, 90.0),
    ),
    banned=(
        "fare_amount",
        "extra",
        "mta_tax",
        "tip_amount",
        "tolls_amount",
        "improvement_surcharge",
        "total_amount",
    ),
    renames=(("RateCodeID", "RatecodeID"),),
)

# Adapter over lineitem joined to orders (see sources.fixtures.trips_li).
TRIPS_LI = TableSpec(
    event_ts="pickup_ts",
    end_ts="dropoff_ts",
    target="total_amount",
    raw_features=(
        "vendor_id",
        "passenger_count",
        "trip_distance",
        "pickup_longitude",
        "pickup_latitude",
        "ratecode_id",
        "store_flag",
        "dropoff_longitude",
        "dropoff_latitude",
    ),
    categorical=("vendor_id", "ratecode_id", "store_flag"),
    distance="trip_distance",
    passengers="passenger_count",
    coordinates=(
        Bound("pickup_longitude", -180.0, 180.0),
        Bound("dropoff_longitude", -180.0, 180.0),
        Bound("pickup_latitude", -90.0, 90.0),
        Bound("dropoff_latitude", -90.0, 90.0),
    ),
    banned=("total_amount",),
)

# Adapter over events with a derived end time (see sources.fixtures.trips_ev); no coordinates.
TRIPS_EV = TableSpec(
    event_ts="pickup_ts",
    end_ts="dropoff_ts",
    target="total_amount",
    raw_features=("passenger_count", "trip_distance", "store_flag"),
    categorical=("store_flag",),
    distance="trip_distance",
    passengers="passenger_count",
    banned=("total_amount",),
)
