"""Summaries.  Each level is combined on the map side before it is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions import is_critical, is_warning, risk_band
from sluice.operators.joins import lookup

# What the daily summary is grouped by.
DAILY_DIMENSIONS = (
    "business_date",
    "event_date",
    "country",
    "customer_region",
    "model",
    "model_year",
    "powertrain",
    "severity",
)
SERVICE_DIMENSIONS = (
    "business_date",
    "dealer_id",
    "dealer_name",
    "country",
    "region",
    "dealer_tier",
    "model",
    "model_year",
    "powertrain",
    "service_type",
)


def _average(name: str) -> Column:
    """Average out of the partial sums ``<name>_sum`` and ``<name>_n``."""
    return F.try_divide(F.sum(f"{name}_sum"), F.sum(f"{name}_n"))


def _partial(name: str) -> list[Column]:
    return [F.sum(name).alias(f"{name}_sum"), F.count(name).alias(f"{name}_n")]


def _all_present(columns: tuple[str, ...]) -> Column:
    present = F.lit(True)
    for name in columns:
        present = present & F.col(name).isNotNull()
    return present


def daily_summary(enriched: DataFrame, null_safe: bool = False) -> DataFrame:
    """Events, vehicles and sensor figures per day and dimension.

    One pass: first per dimensions and vehicle, then per dimensions.  A vehicle
    is then one row, so distinct vehicles are a count of rows and repeat
    offenders a count of rows with more than one warning.

    Groups with a NULL dimension report 0 repeat vehicles unless ``null_safe``.
    """
    per_vehicle = enriched.groupBy(*DAILY_DIMENSIONS, "vin").agg(
        F.count("*").alias("events"),
        F.count_if(F.coalesce(is_critical(F.col("severity")), F.lit(False))).alias("critical"),
        F.count_if(F.coalesce(is_warning(F.col("severity")), F.lit(False))).alias("warnings"),
        F.max("odometer_km").alias("max_odometer"),
        *_partial("odometer_km"),
        *_partial("battery_voltage"),
        *_partial("engine_temp_c"),
    )
    repeated = F.count_if((F.col("warnings") > 1) & F.col("vin").isNotNull())
    if not null_safe:
        repeated = F.when(_all_present(DAILY_DIMENSIONS), repeated).otherwise(0)
    return per_vehicle.groupBy(*DAILY_DIMENSIONS).agg(
        F.sum("events").alias("telemetry_event_count"),
        F.count("vin").alias("affected_vehicle_count"),
        F.sum("critical").alias("critical_dtc_count"),
        _average("odometer_km").alias("avg_odometer_km"),
        F.max("max_odometer").alias("max_odometer_km"),
        _average("battery_voltage").alias("avg_battery_voltage"),
        _average("engine_temp_c").alias("avg_engine_temp_c"),
        repeated.alias("repeated_warning_vehicle_count"),
    )


def repeat_offenders(enriched: DataFrame) -> DataFrame:
    """Vehicles with more than one warning event, per dimension."""
    return (
        enriched.filter(is_warning(F.col("severity")))
        .groupBy(*DAILY_DIMENSIONS, "vin")
        .agg(F.count("*").alias("warnings"))
        .filter(F.col("warnings") > 1)
        .groupBy(*DAILY_DIMENSIONS)
        .agg(F.count("vin").alias("repeated_warning_vehicle_count"))
    )


def service_kpis(
    service: DataFrame,
    vehicles: DataFrame,
    dealers: DataFrame,
    small_vehicles: bool = False,
    small_dealers: bool = False,
) -> DataFrame:
    """Service figures per dealer, vehicle type and service type.

    Services meet their vehicle first, by the vehicle alone: most vehicles have few services of a dealer and type,
    so sums before that join would shuffle nearly as many rows once more.  They are summed per vehicle type before the
    dealer join, so a busy dealer is a few rows when it meets the dealer table.  Both tables hold one row per key.
    """
    figures = ("parts_cost", "service_duration_hours", "labor_hours", "warranty_flag")
    typed = lookup(
        service.select("business_date", "vin", "dealer_id", "service_type", *figures),
        vehicles.select("vin", "model", "model_year", "powertrain"),
        "vin",
        "left",
        small_vehicles,
    )
    per_dealer = typed.groupBy(
        "business_date", "dealer_id", "service_type", "model", "model_year", "powertrain"
    ).agg(
        F.count("*").alias("service_event_count"),
        F.avg("service_duration_hours").alias("avg_service_duration_hours"),
        F.avg("labor_hours").alias("avg_labor_hours"),
        F.sum("parts_cost").cast("decimal(38,2)").alias("total_parts_cost"),
        F.avg(F.col("warranty_flag").cast("double")).alias("warranty_service_rate"),
    )
    dealer = dealers.select("dealer_id", "dealer_name", "country", "region", "dealer_tier")
    named = lookup(per_dealer, dealer, "dealer_id", "left", small=small_dealers)
    figures = [c for c in per_dealer.columns if c not in SERVICE_DIMENSIONS]
    return named.select(*SERVICE_DIMENSIONS, *figures)


def risk_story(summary: DataFrame) -> DataFrame:
    """The daily summary by date, model, customer region and country, with a band.

    The averages weigh every summary group alike, and a vehicle seen in several
    groups counts in each: ``affected_vehicle_groups`` is not a vehicle count.
    """
    events = F.col("telemetry_event_count")
    critical = F.sum("critical_dtc_count")
    warning = F.sum(F.when(is_warning(F.col("severity")), events).otherwise(0))
    high = F.sum(F.when(F.col("severity") == "HIGH", events).otherwise(0))
    return summary.groupBy("business_date", "model", "customer_region", "country").agg(
        F.sum(events).alias("telemetry_events"),
        F.sum("affected_vehicle_count").alias("affected_vehicle_groups"),
        critical.alias("critical_dtc_events"),
        warning.alias("warning_or_critical_events"),
        F.avg("avg_battery_voltage").alias("avg_battery_voltage"),
        F.avg("avg_engine_temp_c").alias("avg_engine_temp_c"),
        risk_band(critical, high).alias("risk_band"),
    )


def risk_listing(story: DataFrame, business_date: str) -> DataFrame:
    """The risk report of one date, worst first."""
    return (
        story.filter(F.col("business_date") == business_date)
        .select(
            "business_date",
            "model",
            "customer_region",
            "country",
            "telemetry_events",
            "warning_or_critical_events",
            "critical_dtc_events",
            "risk_band",
        )
        .orderBy(
            F.desc("critical_dtc_events"),
            F.desc("warning_or_critical_events"),
            F.desc("telemetry_events"),
        )
    )


def daily_revenue(sales: DataFrame) -> DataFrame:
    """Orders, units and revenue per order date.

    Lines are first summed per order, which is also what makes orders distinct,
    so one busy date is spread over its orders.
    """
    per_order = sales.groupBy("order_date", "order_id").agg(
        F.sum("quantity").alias("units"), F.sum("total_amount").alias("revenue")
    )
    return per_order.groupBy("order_date").agg(
        F.count("order_id").alias("order_count"),
        F.sum("units").alias("units_sold"),
        F.round(F.sum("revenue"), 2).alias("total_revenue"),
    )
