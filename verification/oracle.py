"""The expected results as SQL for DuckDB, written against the raw views.

Each statement is a WITH list of what it needs and one SELECT.
"""

from __future__ import annotations

from verification.views import RAW_VIEWS, TABLES

BUSINESS_DATE = "2026-12-01"
EARLIER_DATE = "2026-11-30"
RUN_ID = "run-1"
RUN_TIME = "2026-12-01 06:00:00"
SOURCE_ZIP = "vehicle_health_2026_12_01.zip"
MAX_MODEL_YEAR = 2027


def txt(col: str) -> str:
    return (
        f"(case when upper(trim({col})) in ('', 'NA', 'N/A', 'NULL', 'NONE', 'UNKNOWN') "
        f"then null else trim({col}) end)"
    )


def ident(col: str) -> str:
    return f"upper(regexp_replace({txt(col)}, '[^A-Za-z0-9]', '', 'g'))"


def num(col: str, kind: str = "double") -> str:
    return f"try_cast(regexp_replace({txt(col)}, '[^0-9.-]', '', 'g') as {kind})"


def code(col: str) -> str:
    return f"upper(regexp_replace({txt(col)}, '\\s+', '_', 'g'))"


def title(col: str) -> str:
    return f"concat(upper(substr({txt(col)}, 1, 1)), lower(substr({txt(col)}, 2)))"


def stamp(col: str) -> str:
    return f"try_cast({txt(col)} as timestamp)"


def flag(col: str) -> str:
    return f"(upper({txt(col)}) in ('Y', 'YES', 'TRUE', '1'))"


PROVENANCE = (
    f"'{BUSINESS_DATE}' as business_date, '{SOURCE_ZIP}' as source_zip, "
    f"'{RUN_ID}' as pipeline_run_id, timestamp '{RUN_TIME}' as ingested_at"
)
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


def reasons(pairs: list[tuple[str, str]]) -> str:
    cases = ", ".join(f"case when {cond} then '{reason}' end" for reason, cond in pairs)
    return f"concat_ws('|', {cases})"


VIN_REASONS = [
    ("missing_vin", "vin is null"),
    ("invalid_vin_length", "length(vin) <> 17"),
]
TIRES = ("tire_pressure_fl", "tire_pressure_fr", "tire_pressure_rl", "tire_pressure_rr")
TELEMETRY_REASONS = [
    *VIN_REASONS,
    ("missing_event_timestamp", "event_timestamp is null"),
    ("missing_odometer", "odometer_km is null"),
    ("negative_odometer", "odometer_km < 0"),
    ("unrealistic_odometer", "odometer_km > 500000"),
    ("missing_battery_voltage", "battery_voltage is null"),
    ("invalid_battery_voltage", "battery_voltage not between 8 and 16"),
    ("missing_engine_temperature", "engine_temp_c is null"),
    ("invalid_engine_temperature", "engine_temp_c not between -40 and 160"),
    ("missing_oil_pressure", "oil_pressure_kpa is null"),
    ("invalid_oil_pressure", "oil_pressure_kpa not between 0 and 900"),
    # In these views a missing tire value is always in front of an invalid one.
    ("missing_tire_pressure", " or ".join(f"{t} is null" for t in TIRES)),
    ("invalid_tire_pressure", " or ".join(f"{t} not between 15 and 60" for t in TIRES)),
    ("missing_severity", "severity is null"),
    ("invalid_severity", "severity not in ('LOW', 'MEDIUM', 'HIGH', 'CRITICAL')"),
]
SERVICE_REASONS = [
    ("missing_service_id", "service_id is null"),
    *VIN_REASONS,
    ("missing_dealer_id", "dealer_id is null"),
    ("missing_service_open_timestamp", "service_open_timestamp is null"),
    (
        "invalid_service_status",
        "service_status not in ('OPEN', 'IN_PROGRESS', 'CLOSED', 'CANCELLED')",
    ),
    ("missing_labor_hours", "labor_hours is null"),
    ("negative_labor_hours", "labor_hours < 0"),
    ("missing_parts_cost", "parts_cost is null"),
    ("negative_parts_cost", "parts_cost < 0"),
    (
        "closed_without_close_timestamp",
        "service_status = 'CLOSED' and service_close_timestamp is null",
    ),
    ("close_before_open", "service_close_timestamp < service_open_timestamp"),
]
VEHICLE_REASONS = [
    *VIN_REASONS,
    ("missing_model", "model is null"),
    ("invalid_model_year", f"model_year not between 1948 and {MAX_MODEL_YEAR}"),
    ("invalid_powertrain", "powertrain not in ('ICE', 'HYBRID', 'EV', 'PHEV')"),
    ("future_warranty_start_date", f"warranty_start_date > date '{BUSINESS_DATE}'"),
]
DEALER_REASONS = [
    ("missing_dealer_id", "dealer_id is null"),
    ("missing_dealer_name", "dealer_name is null"),
    ("missing_country", "country is null"),
    ("missing_region", "region is null"),
]


def evaluated(typed: str, keys: str, order: str, pairs: list[tuple[str, str]]) -> str:
    return f"""
    select *, {reasons(pairs)} as reject_reason, {PROVENANCE}
    from (select *, row_number() over (partition by {keys} order by {order}) as rn,
                 count(*) over (partition by {keys}) as copies
          from ({typed}) typed) ranked
    where rn = 1"""


TYPED_TELEMETRY = f"""
    select event_id, copy_no, {ident('vin')} as vin, {stamp('event_timestamp')} as event_timestamp,
      {", ".join(f"{num(c)} as {c}" for c in SENSORS)},
      upper({txt('dtc_code')}) as dtc_code, upper({txt('severity')}) as severity,
      upper({txt('country')}) as country, 'vehicle_telemetry.csv' as source_file,
      cast({stamp('event_timestamp')} as date) as event_date
    from raw_telemetry"""
TYPED_SERVICE = f"""
    select o_orderkey, copy_no, {txt('service_id')} as service_id, {ident('vin')} as vin,
      upper({txt('dealer_id')}) as dealer_id,
      {stamp('service_open_timestamp')} as service_open_timestamp,
      {stamp('service_close_timestamp')} as service_close_timestamp,
      {code('service_type')} as service_type, {flag('warranty_flag')} as warranty_flag,
      {num('labor_hours')} as labor_hours, {num('parts_cost', 'decimal(12,2)')} as parts_cost,
      {code('service_status')} as service_status, 'service_events.csv' as source_file,
      cast({stamp('service_open_timestamp')} as date) as service_date,
      cast(epoch({stamp('service_close_timestamp')}) - epoch({stamp('service_open_timestamp')}) as double)
        / 3600.0 as service_duration_hours
    from raw_service"""
TYPED_VEHICLE = f"""
    select c_custkey, {ident('vin')} as vin, {title('model')} as model_text,
      case when {txt('model')} is null then null else {title('model')} end as model,
      {num('model_year', 'int')} as model_year, upper({txt('powertrain')}) as powertrain,
      upper({txt('production_plant')}) as production_plant,
      try_cast({txt('warranty_start_date')} as date) as warranty_start_date,
      upper({txt('customer_region')}) as customer_region, 'vehicle_master.csv' as source_file
    from raw_vehicle"""
TYPED_DEALER = f"""
    select s_suppkey, upper({txt('dealer_id')}) as dealer_id,
      case when {txt('dealer_name')} is null then null else {title('dealer_name')} end as dealer_name,
      upper({txt('country')}) as country, upper({txt('region')}) as region,
      upper({txt('dealer_tier')}) as dealer_tier, 'dealer_master.csv' as source_file
    from raw_dealer"""

# No order is given: a value comes before none, column by column.
COMPLETE_FIRST = ", ".join(f"{c} is null, {c}" for c in (*SENSORS, "severity", "country"))
DIMENSIONS = (
    "business_date, event_date, country, customer_region, model, model_year, powertrain, severity"
)
ENRICHED_COLUMNS = """t.source_file, t.vin, t.event_timestamp, t.event_date, t.odometer_km,
      t.battery_voltage, t.engine_temp_c, t.oil_pressure_kpa, t.tire_pressure_fl,
      t.tire_pressure_fr, t.tire_pressure_rl, t.tire_pressure_rr, t.dtc_code, t.severity,
      t.country, t.business_date, t.source_zip, t.pipeline_run_id, t.ingested_at,
      v.model_year, v.powertrain, v.production_plant, v.warranty_start_date, v.customer_region,
      l.dealer_id, l.service_type, l.service_status, l.warranty_flag, l.service_duration_hours,
      d.dealer_name, d.region, d.dealer_tier"""

STEPS: dict[str, str] = {
    **{name: sql.format(**{t: t for t in TABLES}) for name, sql in RAW_VIEWS.items()},
    "ev_telemetry": evaluated(
        TYPED_TELEMETRY, "vin, event_timestamp, dtc_code", "event_id, copy_no", TELEMETRY_REASONS
    ),
    "ev_unordered": evaluated(
        TYPED_TELEMETRY, "vin, event_timestamp, dtc_code", COMPLETE_FIRST, TELEMETRY_REASONS
    ),
    "ev_service": evaluated(TYPED_SERVICE, "service_id", "o_orderkey, copy_no", SERVICE_REASONS),
    "ev_vehicle": evaluated(TYPED_VEHICLE, "vin", "c_custkey", VEHICLE_REASONS),
    "ev_dealer": evaluated(TYPED_DEALER, "dealer_id", "s_suppkey", DEALER_REASONS),
    "telemetry": "select * from ev_telemetry where reject_reason = ''",
    "service": "select * from ev_service where reject_reason = ''",
    "vehicle": "select * from ev_vehicle where reject_reason = ''",
    "dealer": "select * from ev_dealer where reject_reason = ''",
    "unknown": "select * from telemetry t where not exists (select 1 from vehicle v where v.vin = t.vin)",
    "latest": """
    select * from (select *, row_number() over (partition by vin
        order by service_open_timestamp desc, service_id) as recency from service) ranked
    where recency = 1""",
    "enriched": f"""
    select {ENRICHED_COLUMNS}, t.severity = 'CRITICAL' as is_critical_event,
      t.severity in ('HIGH', 'CRITICAL') as is_warning_event, v.model
    from telemetry t join vehicle v on t.vin = v.vin left join latest l on t.vin = l.vin
      left join dealer d on l.dealer_id = d.dealer_id""",
    "repeats": f"""
    select {DIMENSIONS}, count(distinct vin) as repeated_warning_vehicle_count
    from (select {DIMENSIONS}, vin, count(*) as n from enriched
          where severity in ('HIGH', 'CRITICAL') group by all) per_vin
    where n > 1 group by all""",
    "summary": f"""
    select b.*, coalesce(r.repeated_warning_vehicle_count, 0) as repeated_warning_vehicle_count
    from (select {DIMENSIONS}, count(*) as telemetry_event_count,
            count(distinct vin) as affected_vehicle_count,
            cast(sum(case when severity = 'CRITICAL' then 1 else 0 end) as bigint) as critical_dtc_count,
            avg(odometer_km) as avg_odometer_km, max(odometer_km) as max_odometer_km,
            avg(battery_voltage) as avg_battery_voltage, avg(engine_temp_c) as avg_engine_temp_c
          from enriched group by {DIMENSIONS}) b
    left join repeats r on b.business_date = r.business_date and b.event_date = r.event_date
      and b.country = r.country and b.customer_region = r.customer_region and b.model = r.model
      and b.model_year = r.model_year and b.powertrain = r.powertrain and b.severity = r.severity""",
    "kpis": """
    select s.business_date, s.dealer_id, d.dealer_name, d.country, d.region, d.dealer_tier,
      v.model, v.model_year, v.powertrain, s.service_type, count(*) as service_event_count,
      avg(service_duration_hours) as avg_service_duration_hours, avg(labor_hours) as avg_labor_hours,
      cast(sum(parts_cost) as decimal(38,2)) as total_parts_cost,
      avg(cast(warranty_flag as int)) as warranty_service_rate
    from service s left join vehicle v on s.vin = v.vin left join dealer d on s.dealer_id = d.dealer_id
    group by all""",
    "story": """
    select business_date, model, customer_region, country,
      cast(sum(telemetry_event_count) as bigint) as telemetry_events,
      cast(sum(affected_vehicle_count) as bigint) as affected_vehicle_groups,
      cast(sum(critical_dtc_count) as bigint) as critical_dtc_events,
      cast(sum(case when severity in ('HIGH', 'CRITICAL') then telemetry_event_count else 0 end) as bigint)
        as warning_or_critical_events,
      round(avg(avg_battery_voltage), 10) as avg_battery_voltage,
      round(avg(avg_engine_temp_c), 10) as avg_engine_temp_c,
      case when sum(critical_dtc_count) > 0 then 'CRITICAL_ATTENTION'
           when sum(case when severity = 'HIGH' then telemetry_event_count else 0 end) > 0
           then 'WATCHLIST' else 'NORMAL' end as risk_band
    from summary group by all""",
    "revenue": """
    select order_date, count(distinct order_id) as order_count,
      cast(sum(quantity) as bigint) as units_sold,
      round(cast(sum(total_amount) as double), 2) as total_revenue
    from clean_sales group by order_date""",
}

# What each step reads, so that a statement carries no more than it uses.
NEEDS: dict[str, tuple[str, ...]] = {
    **{name: () for name in RAW_VIEWS},
    "ev_telemetry": ("raw_telemetry",),
    "ev_unordered": ("raw_telemetry",),
    "ev_service": ("raw_service",),
    "ev_vehicle": ("raw_vehicle",),
    "ev_dealer": ("raw_dealer",),
    "telemetry": ("ev_telemetry",),
    "service": ("ev_service",),
    "vehicle": ("ev_vehicle",),
    "dealer": ("ev_dealer",),
    "unknown": ("telemetry", "vehicle"),
    "latest": ("service",),
    "enriched": ("telemetry", "vehicle", "latest", "dealer"),
    "repeats": ("enriched",),
    "summary": ("enriched", "repeats"),
    "kpis": ("service", "vehicle", "dealer"),
    "story": ("summary",),
    "revenue": ("clean_sales",),
}


def statement(select: str, *steps: str) -> str:
    """A SELECT with the WITH list of the steps it names and all they need."""
    wanted: list[str] = []

    def add(step: str) -> None:
        for need in NEEDS[step]:
            add(need)
        if step not in wanted:
            wanted.append(step)

    for step in steps:
        add(step)
    # Read more than once, so computed once.
    listed = ",\n".join(f"{name} as materialized ({STEPS[name].strip()})" for name in wanted)
    return f"with {listed}\n{select.strip()}"


def clean_select(step: str, columns: str) -> str:
    return statement(
        f"select {columns}, business_date, source_zip, pipeline_run_id, ingested_at from {step}", step
    )


TELEMETRY_OUT = (
    f"vin, event_timestamp, {', '.join(SENSORS)}, dtc_code, severity, country, source_file, event_date"
)
SERVICE_OUT = (
    "service_id, vin, dealer_id, service_open_timestamp, service_close_timestamp, service_type, "
    "warranty_flag, labor_hours, parts_cost, service_status, source_file, service_date, "
    "service_duration_hours"
)
VEHICLE_OUT = (
    "vin, model, model_year, powertrain, production_plant, warranty_start_date, customer_region, "
    "source_file"
)
DEALER_OUT = "dealer_id, dealer_name, country, region, dealer_tier, source_file"


def reasons_select(step: str, keys: str) -> str:
    n = "len(string_split(reject_reason, '|'))"
    return statement(
        f"select {keys}, reject_reason, cast({n} as int) as n_reasons from {step} "
        "where reject_reason <> ''",
        step,
    )


# Rejects: the JSON text is put together field by field, NULL fields left out.
def js(name: str, kind: str) -> str:
    if kind == "text":
        value = f"'\"' || {name} || '\"'"
    elif kind == "time":
        value = f"'\"' || strftime({name}, '%Y-%m-%dT%H:%M:%S') || '.000Z\"'"
    elif kind == "date":
        value = f"'\"' || strftime({name}, '%Y-%m-%d') || '\"'"
    else:
        value = f"cast({name} as varchar)"
    return f"'\"{name}\":' || {value}"


STAMPS = [
    ("business_date", "text"),
    ("source_zip", "text"),
    ("pipeline_run_id", "text"),
    ("ingested_at", "time"),
    ("reject_reason", "text"),
]
TELEMETRY_JSON = [
    ("vin", "text"),
    ("event_timestamp", "time"),
    *[(c, "number") for c in SENSORS],
    ("dtc_code", "text"),
    ("severity", "text"),
    ("country", "text"),
    ("source_file", "text"),
    ("event_date", "date"),
    *STAMPS,
]
SERVICE_JSON = [
    ("service_id", "text"),
    ("vin", "text"),
    ("dealer_id", "text"),
    ("service_open_timestamp", "time"),
    ("service_close_timestamp", "time"),
    ("service_type", "text"),
    ("warranty_flag", "number"),
    ("labor_hours", "number"),
    ("parts_cost", "number"),
    ("service_status", "text"),
    ("source_file", "text"),
    ("service_date", "date"),
    ("service_duration_hours", "number"),
    *STAMPS,
]
VEHICLE_JSON = [
    ("vin", "text"),
    ("model", "text"),
    ("model_year", "number"),
    ("powertrain", "text"),
    ("production_plant", "text"),
    ("warranty_start_date", "date"),
    ("customer_region", "text"),
    ("source_file", "text"),
    *STAMPS,
]
DEALER_JSON = [
    *[(c, "text") for c in ("dealer_id", "dealer_name", "country", "region", "dealer_tier")],
    ("source_file", "text"),
    *STAMPS,
]


def envelope(dataset: str, source: str, fields: list[tuple[str, str]]) -> str:
    body = ", ".join(js(name, kind) for name, kind in fields)
    return (
        f"select '{dataset}' as dataset_name, business_date, pipeline_run_id, reject_reason, "
        f"'{{' || concat_ws(',', {body}) || '}}' as record_json, ingested_at as rejected_at "
        f"from {source}"
    )


REJECTS = " union all ".join(
    [
        envelope("vehicle_telemetry", "(select * from ev_telemetry where reject_reason <> '') r", TELEMETRY_JSON),
        envelope("service_events", "(select * from ev_service where reject_reason <> '') r", SERVICE_JSON),
        envelope("vehicle_master", "(select * from ev_vehicle where reject_reason <> '') r", VEHICLE_JSON),
        envelope("dealer_master", "(select * from ev_dealer where reject_reason <> '') r", DEALER_JSON),
        envelope(
            "vehicle_health_reference",
            "(select * replace ('unknown_vehicle_reference' as reject_reason) from unknown) r",
            TELEMETRY_JSON,
        ),
    ]
)
ALL_EVALUATED = ("ev_telemetry", "ev_service", "ev_vehicle", "ev_dealer")
TOTALS = """
  (select sum(copies) from ev_telemetry) as t_in, (select sum(copies) from ev_service) as s_in,
  (select sum(copies) from ev_vehicle) as v_in, (select sum(copies) from ev_dealer) as d_in,
  (select count(*) from ev_telemetry) + (select count(*) from ev_service)
    + (select count(*) from ev_vehicle) + (select count(*) from ev_dealer) as kept,
  (select count(*) from ev_telemetry where reject_reason <> '')
    + (select count(*) from ev_service where reject_reason <> '')
    + (select count(*) from ev_vehicle where reject_reason <> '')
    + (select count(*) from ev_dealer where reject_reason <> '')
    + (select count(*) from unknown) as rejects"""
GATE = """
  select count(*) as enriched_rows, cast(count(*) filter (vin is null) as bigint) as null_vin,
    count(*) filter (length(vin) <> 17) as invalid_vin_length,
    count(*) filter (model is null) as missing_model,
    count(*) filter (severity not in ('LOW', 'MEDIUM', 'HIGH', 'CRITICAL')) as invalid_severity,
    count(*) filter (odometer_km < 0) as negative_odometer,
    (select count(*) from (select 1 from enriched group by vin, event_timestamp, dtc_code
       having count(*) > 1) dup) as duplicate_event_key
  from enriched"""
GATE_NAMES = (
    "null_vin",
    "invalid_vin_length",
    "missing_model",
    "invalid_severity",
    "negative_odometer",
    "duplicate_event_key",
)


def report_rows() -> str:
    """The report of a run: checks, then counts, without run id and times."""
    checks = " union all ".join(
        f"select 'vehicle_health_enriched' as dataset_name, '{name}' as metric_name, {name} as metric_value, "
        f"case when {name} > 0 then 'FAILED' else 'PASSED' end as status from gate"
        for name in GATE_NAMES
    )
    counts = {
        "telemetry_input_rows": "t_in",
        "service_input_rows": "s_in",
        "vehicle_master_input_rows": "v_in",
        "dealer_master_input_rows": "d_in",
        "vehicle_health_enriched_rows": "(select count(*) from enriched)",
        "daily_summary_rows": "(select count(*) from summary)",
        "service_summary_rows": "(select count(*) from kpis)",
        "reject_rows": "rejects",
        "duplicates_dropped": "t_in + s_in + v_in + d_in - kept",
    }
    infos = " union all ".join(
        f"select 'pipeline', '{name}', {value}, 'INFO' from totals" for name, value in counts.items()
    )
    return f"""
    select dataset_name, metric_name, cast(metric_value as bigint) as metric_value, status
    from (with gate as ({GATE}), totals as (select {TOTALS})
      {checks}
      union all
      select 'daily_vehicle_health_summary', 'summary_reconciliation_delta',
        abs((select count(*) from enriched) - (select sum(telemetry_event_count) from summary)), 'PASSED'
      union all
      {infos}) report"""


RISK_LISTING = f"""
  select business_date, model, customer_region, country, telemetry_events,
    warning_or_critical_events, critical_dtc_events, risk_band
  from story where business_date = '{BUSINESS_DATE}'
  order by critical_dtc_events desc, warning_or_critical_events desc, telemetry_events desc"""


def table_counts(delta: bool) -> str:
    """Rows per analytics table after one load."""
    rows = {
        "vehicle_health_enriched": "select count(*) from enriched",
        "daily_vehicle_health_summary": "select count(*) from summary",
        "service_kpi_summary": "select count(*) from kpis",
    }
    if delta:
        each = "({sql}) as staging_row_count, ({sql}) as target_row_count, cast(0 as bigint) as row_count_delta"
    else:
        each = f"'{BUSINESS_DATE}' as business_date, ({{sql}}) as row_count"
    return " union all ".join(
        f"select '{name}' as table_name, " + each.format(sql=sql) for name, sql in rows.items()
    )


def oracle() -> dict[str, str]:
    text_columns = (
        f"vin, event_timestamp, {', '.join(SENSORS)}, dtc_code, severity, country".split(", ")
    )
    return {
        "nullify_strings": statement(
            "select event_id, copy_no, "
            + ", ".join(f"{txt(c)} as {c}" for c in text_columns)
            + " from raw_telemetry",
            "raw_telemetry",
        ),
        "norm_ids": statement(
            f"select event_id, copy_no, {ident('vin')} as vin, "
            f"cast(length({ident('vin')}) as int) as vin_length from raw_telemetry",
            "raw_telemetry",
        ),
        "clean_numbers": statement(
            "select 'telemetry' as source, event_id as row_key, copy_no, "
            f"{num('odometer_km')} as as_double, {num('odometer_km', 'decimal(12,2)')} as as_decimal, "
            f"{num('odometer_km', 'int')} as as_int from raw_telemetry union all "
            f"select 'service', o_orderkey, copy_no, {num('parts_cost')}, "
            f"{num('parts_cost', 'decimal(12,2)')}, null from raw_service",
            "raw_telemetry",
            "raw_service",
        ),
        "parse_times": statement(
            f"select 'telemetry' as source, event_id as row_key, copy_no, {stamp('event_timestamp')} as as_timestamp, "
            f"cast({stamp('event_timestamp')} as date) as as_date from raw_telemetry union all "
            f"select 'vehicle', c_custkey, 0, {stamp('warranty_start_date')}, "
            f"try_cast({txt('warranty_start_date')} as date) from raw_vehicle",
            "raw_telemetry",
            "raw_vehicle",
        ),
        "norm_codes": statement(
            f"select o_orderkey, copy_no, {code('service_type')} as service_type, "
            f"{code('service_status')} as service_status, upper({txt('dealer_id')}) as dealer_id "
            "from raw_service",
            "raw_service",
        ),
        "title_case": statement(
            f"select c_custkey, case when {txt('model')} is null then null else {title('model')} end as model "
            "from raw_vehicle",
            "raw_vehicle",
        ),
        "flags_and_hours": statement(
            f"select o_orderkey, copy_no, {flag('warranty_flag')} as warranty_flag, "
            f"cast({flag('warranty_flag')} as double) as warranty_number, "
            f"cast(epoch({stamp('service_close_timestamp')}) - epoch({stamp('service_open_timestamp')}) as double)"
            " / 3600.0 as hours from raw_service",
            "raw_service",
        ),
        "dedupe_telemetry": statement(
            f"select {TELEMETRY_OUT}, copies from ev_telemetry", "ev_telemetry"
        ),
        "dedupe_service": statement(f"select {SERVICE_OUT}, copies from ev_service", "ev_service"),
        "dedupe_unordered": statement(
            f"select {TELEMETRY_OUT}, copies from ev_unordered", "ev_unordered"
        ),
        "clean_telemetry": clean_select("telemetry", TELEMETRY_OUT),
        "clean_service": clean_select("service", SERVICE_OUT),
        "clean_vehicle": clean_select("vehicle", VEHICLE_OUT),
        "clean_dealer": clean_select("dealer", DEALER_OUT),
        "reject_reasons_telemetry": reasons_select("ev_telemetry", "vin, event_timestamp, dtc_code"),
        "reject_reasons_service": reasons_select("ev_service", "service_id"),
        "reject_reasons_vehicle": reasons_select("ev_vehicle", "vin"),
        "reject_reasons_dealer": reasons_select("ev_dealer", "dealer_id"),
        "reject_reason_counts": statement(
            "select dataset_name, reason, count(*) as row_count from ("
            "select dataset_name, unnest(string_split(reject_reason, '|')) as reason from ("
            f"{REJECTS}) r) x group by all",
            *ALL_EVALUATED,
            "unknown",
        ),
        "reject_envelope": statement(REJECTS, *ALL_EVALUATED, "unknown"),
        "reject_raw_text": statement(
            "select e.reject_reason, r.vin, r.event_timestamp, r.odometer_km, r.engine_temp_c, "
            "r.oil_pressure_kpa, r.severity from ev_telemetry e join raw_telemetry r using (event_id, copy_no) "
            "where e.reject_reason <> ''",
            "ev_telemetry",
        ),
        "unknown_vehicles": statement(f"select {TELEMETRY_OUT} from unknown", "unknown"),
        "latest_service": statement(
            "select vin, dealer_id, service_type, service_status, warranty_flag, service_duration_hours from latest",
            "latest",
        ),
        "enriched": statement("select * from enriched", "enriched"),
        "daily_summary": statement("select * from summary", "summary"),
        "repeat_offenders": statement("select * from repeats", "repeats"),
        "service_kpis": statement("select * from kpis", "kpis"),
        "risk_story": statement("select * from story", "story"),
        "risk_listing": statement(RISK_LISTING, "story"),
        "daily_revenue": statement("select * from revenue", "revenue"),
        "duplicate_keys": statement(
            "select vin, event_timestamp, dtc_code, count(*) as row_count from raw_telemetry "
            "group by all having count(*) > 1",
            "raw_telemetry",
        ),
        "gate_metrics": statement(GATE, "enriched"),
        "reconcile": statement(
            "select (select count(*) from enriched) as detail_rows, "
            "(select cast(sum(telemetry_event_count) as bigint) from summary) as summary_rows, "
            "cast(abs((select count(*) from enriched) - (select sum(telemetry_event_count) from summary)) as bigint)"
            " as summary_reconciliation_delta",
            "summary",
        ),
        "reject_rate": statement(
            "select input_rows, reject_rows, cast(reject_rows as double) / input_rows as reject_rate, "
            "cast(reject_rows as double) / input_rows > 0.1 as too_high from ("
            f"select cast(t_in + s_in + v_in + d_in as bigint) as input_rows, rejects as reject_rows from (select {TOTALS}) x) y",
            *ALL_EVALUATED,
            "unknown",
        ),
        "quality_report": statement(
            report_rows(), *ALL_EVALUATED, "unknown", "enriched", "summary", "kpis"
        ),
        "slice_counts": statement(table_counts(delta=False), "enriched", "summary", "kpis"),
        "count_delta": statement(table_counts(delta=True), "enriched", "summary", "kpis"),
        "csv_roundtrip": statement(
            "select dealer_id, dealer_name, country, region, dealer_tier, "
            "'dealer_master.csv' as source_file from raw_dealer",
            "raw_dealer",
        ),
        # A CSV file does not tell empty text from no text: both are read as NULL.
        "archive_ingest": statement(
            "select "
            + ", ".join(f"nullif({c}, '') as {c}" for c in text_columns)
            + ", 'vehicle_telemetry.csv' as source_file from raw_telemetry",
            "raw_telemetry",
        ),
        "slice_overwrite": statement(
            f"select * replace ('{EARLIER_DATE}' as business_date) from summary union all "
            "select * from summary where severity in ('HIGH', 'CRITICAL')",
            "summary",
        ),
        "slice_failed_rewrite": statement("select * from summary", "summary"),
        "append_rerun": statement("select * from kpis union all select * from kpis", "kpis"),
        "partition_sync": statement(
            f"select * replace ('{EARLIER_DATE}' as business_date) from summary", "summary"
        ),
        "hot_vehicle_lookup": statement(
            "select e.vin, count(*) as events, count(v.vin) as found from ev_telemetry e "
            "left join vehicle v on e.vin = v.vin group by 1",
            "ev_telemetry",
            "vehicle",
        ),
        "warehouse_resume": statement(
            table_counts(delta=False) + f" union all select 'data_quality_report', '{BUSINESS_DATE}', 16",
            "enriched",
            "summary",
            "kpis",
        ),
        "table_load": statement("select * from kpis", "kpis"),
        "partition_diff": statement(
            f"select distinct 'business_date={BUSINESS_DATE}/model=' || model as partition, "
            "'new' as state from summary",
            "summary",
        ),
        "register_partitions": statement(
            f"select * replace ('{EARLIER_DATE}' as business_date) from summary union all "
            "select * from summary",
            "summary",
        ),
        "register_moved_root": statement(
            "select * from summary where severity in ('HIGH', 'CRITICAL')", "summary"
        ),
        "write_modes": statement(
            "select *, 'append' as written_as from kpis union all "
            "select *, 'append' from kpis union all select *, 'csv' from kpis",
            "kpis",
        ),
        "view_risk_story": statement("select * from story", "story"),
        "view_daily_revenue": statement("select * from revenue", "revenue"),
        "health_job": statement(
            report_rows(), *ALL_EVALUATED, "unknown", "enriched", "summary", "kpis"
        ),
        "warehouse_job": statement(
            table_counts(delta=True)
            + " union all select 'data_quality_report', 16, 16, 0",  # 7 checks, 9 counts
            "enriched",
            "summary",
            "kpis",
        ),
        "warehouse_counts": statement(
            table_counts(delta=False) + f" union all select 'data_quality_report', '{BUSINESS_DATE}', 16",
            "enriched",
            "summary",
            "kpis",
        ),
        "quality_listing": statement(
            f"select *, '{BUSINESS_DATE}' as business_date from ({report_rows()}) listed",
            *ALL_EVALUATED,
            "unknown",
            "enriched",
            "summary",
            "kpis",
        ),
        "sales_job": statement("select * from revenue", "revenue"),
    }
