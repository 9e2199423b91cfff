"""Table contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


_TYPES = {
    "STRING": T.StringType(),
    "DOUBLE": T.DoubleType(),
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
}


def _struct(columns: str, **nested: T.DataType) -> T.StructType:
    """``name TYPE`` pairs, then nested columns; needs no running session."""
    fields = [c.split() for c in columns.split(",") if c.strip()]
    flat = [T.StructField(name, _TYPES[kind]) for name, kind in fields]
    return T.StructType(flat + [T.StructField(name, kind) for name, kind in nested.items()])


DIM_ROUTES = _struct(
    "route_id STRING, station_code STRING, date STRING, departure_time_utc STRING, "
    "executor_capacity_cm3 DOUBLE, route_score STRING"
)
FACT_STOPS = _struct(
    "route_id STRING, stop_id STRING, lat DOUBLE, lng DOUBLE, stop_type STRING, zone_id STRING"
)
DIM_PACKAGES = _struct(
    "route_id STRING, stop_id STRING, package_id STRING, scan_status STRING, "
    "time_window_start STRING, time_window_end STRING, planned_service_time_seconds DOUBLE, "
    "depth_cm DOUBLE, height_cm DOUBLE, width_cm DOUBLE"
)
FACT_ACTUAL_SEQUENCES = _struct(
    "route_id STRING, stop_id STRING, actual_sequence_position BIGINT"
)
FACT_TRAVEL_TIMES = _struct(
    "route_id STRING, from_stop_id STRING, to_stop_id STRING, travel_seconds DOUBLE"
)
ROUTE_COMPARISON = _struct(
    "route_id STRING, num_stops INT, nn_time_seconds DOUBLE, nn_violations INT, "
    "algo_time_seconds DOUBLE, algo_violations INT, actual_time_seconds DOUBLE, "
    "actual_violations INT, algo_passes_run INT"
)
FAILURE_ROUTES = _struct(
    "route_id STRING, num_stops INT, algo_violations INT, algo_time_seconds DOUBLE, "
    "actual_time_seconds DOUBLE, algo_passes_run INT"
)

# Raw documents: dynamic keys are maps.
ROUTE_DOC = _struct(
    "station_code STRING, date_YYYY_MM_DD STRING, departure_time_utc STRING, "
    "executor_capacity_cm3 DOUBLE, route_score STRING",
    stops=T.MapType(T.StringType(), _struct("lat DOUBLE, lng DOUBLE, type STRING, zone_id STRING")),
)
PACKAGE_DOC = T.MapType(
    T.StringType(),
    T.MapType(
        T.StringType(),
        _struct(
            "scan_status STRING, planned_service_time_seconds DOUBLE",
            time_window=_struct("start_time_utc STRING, end_time_utc STRING"),
            dimensions=_struct("depth_cm DOUBLE, height_cm DOUBLE, width_cm DOUBLE"),
        ),
    ),
)
SEQUENCE_DOC = _struct("", actual=T.MapType(T.StringType(), T.LongType()))
TRAVEL_DOC = T.MapType(T.StringType(), T.MapType(T.StringType(), T.DoubleType()))

STATION = "Station"


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Order, cast and check the columns of ``df`` against a contract."""
    return df.to(schema)
