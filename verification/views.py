"""Raw vehicle and sales tables derived from the given tables.

The given tables hold no vehicle data, so each raw table is a view on them:
dirty text with null markers, units, bad times, short identifiers, copies of
the same key, vehicles and dealers nobody knows.  The SQL runs unchanged in
Spark and DuckDB.  Every row of the given tables is used.  Some rows come
twice, which is what dedupe is about, one vehicle has a third of the events, and some customers have a vehicle that no
event names, which leaves events of unknown vehicles.  Vehicles and dealers of services
grow with the tables; one dealer in six is unknown.
"""

from __future__ import annotations

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

RAW_TELEMETRY = """
select event_id, copy_no,
  case when event_id % 50 = 0 then ' n/a '
       when event_id % 50 = 1 then concat('xx0-zzz ', lpad(cast(user_id as string), 11, '0'))
       when event_id % 50 = 2 then 'XX0ZZZ12'
       when event_id % 3 = 1 then concat('XX0ZZZ', lpad('1', 11, '0'))
       else concat('XX0ZZZ', lpad(cast(user_id as string), 11, '0')) end as vin,
  case when event_id % 61 = 0 then 'not-a-time'
       else cast(date_trunc('second', ts) as string) end as event_timestamp,
  case when event_id % 53 = 0 then '-5'
       when event_id % 59 = 0 then '900,000'
       when event_id % 67 = 0 then 'UNKNOWN'
       else concat(cast((event_id * 37) % 400000 + copy_no as string), ' km') end as odometer_km,
  case when event_id % 71 = 0 then '20.5' when event_id % 89 = 0 then 'null'
       else concat(cast(9 + event_id % 6 as string), '.5V') end as battery_voltage,
  case when event_id % 73 = 0 then '200' when event_id % 97 = 0 then 'n/a'
       else concat(cast(70 + event_id % 50 as string), ' C') end as engine_temp_c,
  case when event_id % 101 = 0 then '950' when event_id % 103 = 0 then 'none'
       else cast(200 + event_id % 300 as string) end as oil_pressure_kpa,
  case when event_id % 79 = 0 then 'NA' else cast(30 + event_id % 6 as string) end as tire_pressure_fl,
  case when event_id % 79 = 0 then 'NA' else cast(30 + event_id % 5 as string) end as tire_pressure_fr,
  case when event_id % 83 = 0 then '70' else cast(30 + event_id % 4 as string) end as tire_pressure_rl,
  cast(31 + event_id % 3 as string) as tire_pressure_rr,
  case when event_type = 'error' then 'p0300' when event_type = 'click' then 'none'
       else event_type end as dtc_code,
  case when event_id % 107 = 0 then '' when event_type = 'error' then ' critical'
       when event_type = 'purchase' then 'High' when event_type = 'view' then 'MEDIUM'
       when event_id % 11 = 0 then 'SEVERE' else 'low' end as severity,
  case event_id % 5 when 0 then 'de' when 1 then 'us ' when 2 then 'Fr' when 3 then 'jp'
       else 'n/a' end as country
from (select *, 0 as copy_no from {events}
      union all
      select *, 1 as copy_no from {events} where event_id % 13 = 0) as copies
"""

RAW_SERVICE = """
select o_orderkey, copy_no,
  case when o_orderkey % 127 = 0 then 'NA'
       else concat('SVC', lpad(cast(o_orderkey as string), 8, '0')) end as service_id,
  case when o_orderkey % 131 = 0 then 'unknown' when o_orderkey % 137 = 0 then 'SHORT'
       else concat('XX0ZZZ', lpad(cast(o_custkey as string), 11, '0')) end as vin,
  case when o_orderkey % 139 = 0 then ' n/a'
       else concat(' d', lpad(cast(cast(floor(o_orderkey / 125) as int) as string), 9, '0')) end as dealer_id,
  case when o_orderkey % 149 = 0 then 'bad-time'
       else cast(o_orderdate as string) end as service_open_timestamp,
  case when o_orderkey % 3 = 0 then null
       when o_orderkey % 17 = 0 then '1990-01-01 00:00:00'
       else cast(o_orderdate + interval '5' hour as string) end as service_close_timestamp,
  substr(o_orderpriority, 3) as service_type,
  case o_orderstatus when 'P' then 'in progress' when 'F' then 'Closed'
       else case when o_orderkey % 19 = 0 then 'paused' else 'open' end end as service_status,
  case o_orderkey % 4 when 0 then 'Y' when 1 then 'no' when 2 then 'TRUE' else 'NA' end as warranty_flag,
  case when o_orderkey % 23 = 0 then '-2' when o_orderkey % 151 = 0 then ''
       else concat(cast(1 + o_orderkey % 9 as string), '.5 h') end as labor_hours,
  case when o_orderkey % 157 = 0 then 'NULL' when o_orderkey % 163 = 0 then '-3.50'
       else concat('EUR ', cast(cast(o_totalprice as decimal(12,2)) as string)) end as parts_cost
from (select *, 0 as copy_no from {orders}
      union all
      select *, 1 as copy_no from {orders} where o_orderkey % 29 = 0) as copies
"""

RAW_VEHICLE = """
select c_custkey,
  case when c_custkey % 43 = 0 then 'xx0zzz1' when c_custkey % 47 = 0 then 'n/a'
       when c_custkey % 10 = 3 then concat('xx1zzz', lpad(cast(c_custkey as string), 11, '0'))
       else concat('xx0zzz', lpad(cast(c_custkey as string), 11, '0')) end as vin,
  case when c_custkey % 31 = 0 then 'n/a' else lower(c_mktsegment) end as model,
  case when c_custkey % 29 = 0 then '1900' when c_custkey % 37 = 0 then 'NA'
       else cast(2000 + c_custkey % 25 as string) end as model_year,
  case c_custkey % 5 when 0 then 'ice' when 1 then 'Hybrid' when 2 then 'EV' when 3 then 'phev' else
       case when c_custkey % 2 = 0 then 'diesel' else 'ev' end end as powertrain,
  lower(n_name) as production_plant,
  case when c_custkey % 53 = 0 then '2999-01-15'
       else concat('20', lpad(cast(c_custkey % 24 as string), 2, '0'), '-01-15') end as warranty_start_date,
  lower(r_name) as customer_region
from {customer} join {nation} on c_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey
"""

RAW_DEALER = """
select s_suppkey,
  case when s_suppkey % 17 = 0 then 'na' else concat('d', lpad(cast(s_suppkey as string), 9, '0')) end as dealer_id,
  case when s_suppkey % 41 = 0 then 'none' else upper(s_name) end as dealer_name,
  case when s_suppkey % 19 = 0 then 'N/A' else lower(n_name) end as country,
  case when s_suppkey % 23 = 0 then 'unknown' else r_name end as region,
  concat('tier ', cast(s_suppkey % 3 as string)) as dealer_tier
from {supplier} join {nation} on s_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey
"""

CLEAN_SALES = """
select concat('SO', cast(l_orderkey as string)) as order_id,
  concat('C', cast(o_custkey as string)) as customer_id, p_name as product_name,
  cast(l_quantity as int) as quantity, p_retailprice as unit_price,
  cast(l_extendedprice as decimal(18,2)) as total_amount, cast(o_orderdate as date) as order_date
from {lineitem} join {orders} on l_orderkey = o_orderkey join {part} on l_partkey = p_partkey
"""

RAW_VIEWS = {
    "raw_telemetry": RAW_TELEMETRY,
    "raw_service": RAW_SERVICE,
    "raw_vehicle": RAW_VEHICLE,
    "raw_dealer": RAW_DEALER,
    "clean_sales": CLEAN_SALES,
}
ORDER_BY = {
    "telemetry": ("event_id", "copy_no"),
    "service": ("o_orderkey", "copy_no"),
    "vehicles": ("c_custkey",),
    "dealers": ("s_suppkey",),
}
