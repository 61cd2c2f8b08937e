"""Lookups into reference tables, safe for keys that hold a large share of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions import is_critical, is_warning
from sluice.operators.dedupe import latest_by

# Reference data measured to be at most this large may be broadcast.
BROADCAST_BYTES = 64 * 1024 * 1024


def lookup(left: DataFrame, ref: DataFrame, key: str, how: str = "left", small: bool = False) -> DataFrame:
    """Join rows to a reference table with one row per key.

    ``small`` says the reference was measured to be below BROADCAST_BYTES.
    Otherwise both sides are shuffled, and adaptive execution cuts the
    partition of a heavy key into several tasks (see ``configure``).
    """
    return left.join(F.broadcast(ref) if small else ref, key, how)


def unknown_refs(
    df: DataFrame,
    ref: DataFrame,
    key: str,
    small: bool = False,
) -> DataFrame:
    """Rows whose key is absent from the reference; rows without a key are too."""
    return lookup(df, ref.select(key), key, "left_anti", small)


# What enrichment takes from each reference table.
VEHICLE_COLUMNS = (
    "vin",
    "model",
    "model_year",
    "powertrain",
    "production_plant",
    "warranty_start_date",
    "customer_region",
)
SERVICE_COLUMNS = (
    "vin",
    "dealer_id",
    "service_type",
    "service_status",
    "warranty_flag",
    "service_duration_hours",
)
DEALER_COLUMNS = ("dealer_id", "dealer_name", "region", "dealer_tier")


def latest_service(service: DataFrame) -> DataFrame:
    """The service opened last per vehicle; ties go to the smallest service id.

    It may have been opened after the event it is later attached to.
    """
    order = [F.col("service_open_timestamp").desc_nulls_last(), F.col("service_id").asc()]
    wanted = service.select(*SERVICE_COLUMNS, "service_open_timestamp", "service_id")
    return latest_by(wanted, ["vin"], order).select(*SERVICE_COLUMNS)


def vehicle_profile(
    service: DataFrame,
    vehicles: DataFrame,
    dealers: DataFrame,
    small_dealers: bool = False,
) -> DataFrame:
    """One row per known vehicle: master data, latest service and its dealer.

    All that enrichment needs hangs on the vehicle, so the small tables are
    joined to each other first and the events are shuffled only once.
    """
    serviced = lookup(
        latest_service(service),
        dealers.select(*DEALER_COLUMNS),
        "dealer_id",
        "left",
        small_dealers,
    )
    return vehicles.select(*VEHICLE_COLUMNS).join(serviced, "vin", "left")


def attach_profile(
    telemetry: DataFrame,
    profile: DataFrame,
    how: str = "inner",
    small: bool = False,
) -> DataFrame:
    """Events with the profile of their vehicle and the severity flags."""
    return lookup(telemetry, profile, "vin", how, small).withColumns(
        {
            "is_critical_event": is_critical(F.col("severity")),
            "is_warning_event": is_warning(F.col("severity")),
        }
    )


def enrich(
    telemetry: DataFrame,
    service: DataFrame,
    vehicles: DataFrame,
    dealers: DataFrame,
) -> DataFrame:
    """Events of known vehicles with master data, latest service and dealer."""
    profile = vehicle_profile(service, vehicles, dealers)
    return attach_profile(telemetry, profile, "inner")
