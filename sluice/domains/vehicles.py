"""Vehicle health: four raw tables, their rules, and the seven outputs."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from sluice.context import Run
from sluice.functions import (
    hours_between,
    norm_code,
    norm_id,
    title_case,
    to_dt,
    to_flag,
    to_number,
    to_ts,
    trim_upper,
)
from sluice.operators import rules as r
from sluice.operators.cleaning import Dataset
from sluice.sinks.tables import OutputSpec

# Allowed codes, file names and raw columns in file order.
SEVERITIES = ("LOW", "MEDIUM", "HIGH", "CRITICAL")
SERVICE_STATUSES = ("OPEN", "IN_PROGRESS", "CLOSED", "CANCELLED")
POWERTRAINS = ("ICE", "HYBRID", "EV", "PHEV")
FIRST_MODEL_YEAR = 1948
VIN_LENGTH = 17
EVENT_KEY = ("vin", "event_timestamp", "dtc_code")
UNKNOWN_VEHICLE = "unknown_vehicle_reference"
UNKNOWN_VEHICLE_DATASET = "vehicle_health_reference"
SENSORS = (
    "odometer_km",
    "battery_voltage",
    "engine_temp_c",
    "oil_pressure_kpa",
    "tire_pressure_fl",
    "tire_pressure_fr",
    "tire_pressure_rl",
    "tire_pressure_rr",
)
TELEMETRY_COLUMNS = ("vin", "event_timestamp", *SENSORS, "dtc_code", "severity", "country")
SERVICE_COLUMNS = (
    "service_id",
    "vin",
    "dealer_id",
    "service_open_timestamp",
    "service_close_timestamp",
    "service_type",
    "warranty_flag",
    "labor_hours",
    "parts_cost",
    "service_status",
)
VEHICLE_COLUMNS = (
    "vin",
    "model",
    "model_year",
    "powertrain",
    "production_plant",
    "warranty_start_date",
    "customer_region",
)
DEALER_COLUMNS = ("dealer_id", "dealer_name", "country", "region", "dealer_tier")


def _vin_rules() -> list[r.Rule]:
    return [r.missing("vin", "missing_vin"), r.not_length("vin", VIN_LENGTH, "invalid_vin_length")]


def telemetry_rules(run: Run) -> list[r.Rule]:
    # Reasons, bounds and order are part of the result.
    rules = [
        *_vin_rules(),
        r.missing("event_timestamp", "missing_event_timestamp"),
        r.missing("odometer_km", "missing_odometer"),
        r.below("odometer_km", 0, "negative_odometer"),
        r.above("odometer_km", 500000, "unrealistic_odometer"),
    ]
    for column, name, least, most in (
        ("battery_voltage", "battery_voltage", 8, 16),
        ("engine_temp_c", "engine_temperature", -40, 160),
        ("oil_pressure_kpa", "oil_pressure", 0, 900),
        ("tire_pressure_fl", "tire_pressure", 15, 60),
        ("tire_pressure_fr", "tire_pressure", 15, 60),
        ("tire_pressure_rl", "tire_pressure", 15, 60),
        ("tire_pressure_rr", "tire_pressure", 15, 60),
    ):
        rules += [
            r.missing(column, f"missing_{name}"),
            r.outside(column, least, most, f"invalid_{name}"),
        ]
    return [
        *rules,
        r.missing("severity", "missing_severity"),
        r.not_among("severity", SEVERITIES, "invalid_severity"),
    ]


def service_rules(run: Run) -> list[r.Rule]:
    closed, opened = F.col("service_close_timestamp"), F.col("service_open_timestamp")
    return [
        r.missing("service_id", "missing_service_id"),
        *_vin_rules(),
        r.missing("dealer_id", "missing_dealer_id"),
        r.missing("service_open_timestamp", "missing_service_open_timestamp"),
        r.not_among("service_status", SERVICE_STATUSES, "invalid_service_status"),
        r.missing("labor_hours", "missing_labor_hours"),
        r.below("labor_hours", 0, "negative_labor_hours"),
        r.missing("parts_cost", "missing_parts_cost"),
        r.below("parts_cost", 0, "negative_parts_cost"),
        r.Rule(
            "closed_without_close_timestamp",
            closed.isNull() & (F.col("service_status") == "CLOSED"),
        ),
        r.Rule("close_before_open", closed < opened),
    ]


def vehicle_rules(run: Run) -> list[r.Rule]:
    return [
        *_vin_rules(),
        r.missing("model", "missing_model"),
        r.outside("model_year", FIRST_MODEL_YEAR, run.today.year + 1, "invalid_model_year"),
        r.not_among("powertrain", POWERTRAINS, "invalid_powertrain"),
        r.above("warranty_start_date", F.lit(run.today), "future_warranty_start_date"),
    ]


def dealer_rules(run: Run) -> list[r.Rule]:
    return [
        r.missing("dealer_id", "missing_dealer_id"),
        r.missing("dealer_name", "missing_dealer_name"),
        r.missing("country", "missing_country"),
        r.missing("region", "missing_region"),
    ]


TELEMETRY = Dataset(
    name="vehicle_telemetry",
    file_name="vehicle_telemetry.csv",
    columns=TELEMETRY_COLUMNS,
    keys=EVENT_KEY,
    rules=telemetry_rules,
    casts={"vin": norm_id, **dict.fromkeys(("dtc_code", "severity", "country"), F.upper)},
    parsers={"event_timestamp": to_ts, **dict.fromkeys(SENSORS, to_number)},
    derived={"event_date": lambda: F.to_date("event_timestamp")},
)

SERVICE = Dataset(
    name="service_events",
    file_name="service_events.csv",
    columns=SERVICE_COLUMNS,
    keys=("service_id",),
    rules=service_rules,
    casts={
        "vin": norm_id,
        "dealer_id": trim_upper,
        "service_type": norm_code,
        "warranty_flag": to_flag,
        "service_status": norm_code,
    },
    parsers={
        "service_open_timestamp": to_ts,
        "service_close_timestamp": to_ts,
        "labor_hours": to_number,
        "parts_cost": partial(to_number, type_name="decimal(12,2)"),
    },
    derived={
        "service_date": lambda: F.to_date("service_open_timestamp"),
        "service_duration_hours": lambda: hours_between(
            F.col("service_open_timestamp"), F.col("service_close_timestamp")
        ),
    },
)

VEHICLES = Dataset(
    name="vehicle_master",
    file_name="vehicle_master.csv",
    columns=VEHICLE_COLUMNS,
    keys=("vin",),
    rules=vehicle_rules,
    casts={
        "vin": norm_id,
        "model": title_case,
        **dict.fromkeys(("powertrain", "production_plant", "customer_region"), F.upper),
    },
    parsers={"model_year": partial(to_number, type_name="int"), "warranty_start_date": to_dt},
)

DEALERS = Dataset(
    name="dealer_master",
    file_name="dealer_master.csv",
    columns=DEALER_COLUMNS,
    keys=("dealer_id",),
    rules=dealer_rules,
    casts={
        "dealer_id": trim_upper,
        "dealer_name": title_case,
        **dict.fromkeys(("country", "region", "dealer_tier"), F.upper),
    },
)

DATASETS = (TELEMETRY, SERVICE, VEHICLES, DEALERS)

# The published tables, their columns in order and their layout.
OUTPUTS = {
    spec.name: spec
    for spec in (
        OutputSpec(
            "vehicle_telemetry_clean",
            """source_file string, vin string, event_timestamp timestamp, event_date date,
            odometer_km double, battery_voltage double, engine_temp_c double,
            oil_pressure_kpa double, tire_pressure_fl double, tire_pressure_fr double,
            tire_pressure_rl double, tire_pressure_rr double, dtc_code string, severity string,
            source_zip string, pipeline_run_id string, ingested_at timestamp,
            business_date string, country string""",
            ("business_date", "country"),
        ),
        OutputSpec(
            "service_events_clean",
            """source_file string, service_id string, vin string, dealer_id string,
            service_open_timestamp timestamp, service_close_timestamp timestamp,
            service_date date, service_type string, warranty_flag boolean, labor_hours double,
            parts_cost decimal(12,2), service_duration_hours double, service_status string,
            source_zip string, pipeline_run_id string, ingested_at timestamp,
            business_date string""",
            ("business_date",),
        ),
        OutputSpec(
            "vehicle_health_enriched",
            """source_file string, vin string, event_timestamp timestamp, event_date date,
            odometer_km double, battery_voltage double, engine_temp_c double,
            oil_pressure_kpa double, tire_pressure_fl double, tire_pressure_fr double,
            tire_pressure_rl double, tire_pressure_rr double, dtc_code string, severity string,
            country string, business_date string, source_zip string, pipeline_run_id string,
            ingested_at timestamp, model_year int, powertrain string, production_plant string,
            warranty_start_date date, customer_region string, dealer_id string,
            service_type string, service_status string, warranty_flag boolean,
            service_duration_hours double, dealer_name string, region string,
            dealer_tier string, is_critical_event boolean, is_warning_event boolean,
            model string""",
            ("business_date", "model"),
        ),
        OutputSpec(
            "daily_vehicle_health_summary",
            """business_date string, event_date date, country string, customer_region string,
            model_year int, powertrain string, severity string, telemetry_event_count bigint,
            affected_vehicle_count bigint, critical_dtc_count bigint, avg_odometer_km double,
            max_odometer_km double, avg_battery_voltage double, avg_engine_temp_c double,
            repeated_warning_vehicle_count bigint, model string""",
            ("business_date", "model"),
        ),
        OutputSpec(
            "service_kpi_summary",
            """business_date string, dealer_id string, dealer_name string, country string,
            dealer_tier string, model string, model_year int, powertrain string,
            service_type string, service_event_count bigint, avg_service_duration_hours double,
            avg_labor_hours double, total_parts_cost decimal(38,2),
            warranty_service_rate double, region string""",
            ("business_date", "region"),
        ),
        OutputSpec(
            "rejects",
            """pipeline_run_id string, reject_reason string, record_json string,
            rejected_at timestamp, business_date string, dataset_name string""",
            ("business_date", "dataset_name"),
        ),
        OutputSpec(
            "data_quality_report",
            """dataset_name string, metric_name string, metric_value bigint, status string,
            business_date string, pipeline_run_id string, reported_at timestamp""",
            ("business_date",),
        ),
    )
}

# The tables the warehouse keeps, each partitioned by date alone.
ANALYTICS_TABLES = (
    "vehicle_health_enriched",
    "daily_vehicle_health_summary",
    "service_kpi_summary",
    "data_quality_report",
)
