"""SQL that gives the same result as each query, for another engine to check.

``BASE`` makes trips and zones from the given tables and repeats each step; a
query's text is the base followed by its own select.
"""

from triplake.schemas import RAW_TRIPS

BASE = """
with trips_src as (
  select 'yellow_tripdata_' || case when l_linenumber = 7 then '1900-01'
           else strftime(o_orderdate,'%Y-%m') end || '.parquet' as file_name,
    cast(l_linenumber as bigint) as VendorID,
    case when l_partkey % 103 = 0 then null else o_orderdate end as tpep_pickup_datetime,
    case when l_partkey % 101 = 0 then null else l_shipdate end as tpep_dropoff_datetime,
    case when l_quantity = 50 then null else (l_quantity % 12) - 1 end as passenger_count,
    case when l_partkey % 97 = 0 then null else l_discount end as trip_distance,
    cast(l_linenumber as double) as RatecodeID,
    l_returnflag as store_and_fwd_flag,
    cast(s_nationkey as bigint) as PULocationID,
    cast(c_nationkey as bigint) as DOLocationID,
    cast(l_linenumber as bigint) as payment_type,
    case when l_partkey % 89 = 0 then null when l_partkey % 53 = 0 then -l_extendedprice
         else l_extendedprice end as fare_amount,
    l_tax as extra,
    cast(0.5 as double) as mta_tax,
    l_discount as tip_amount,
    cast(0 as double) as tolls_amount,
    cast(1 as double) as improvement_surcharge,
    l_extendedprice as total_amount,
    case when l_linenumber = 1 then null else cast(2.5 as double) end as congestion_surcharge,
    cast(null as double) as airport_fee
  from lineitem join orders on l_orderkey = o_orderkey
    join customer on o_custkey = c_custkey join supplier on l_suppkey = s_suppkey),
zones_fx as (
  select n_nationkey as LocationID,
    case when n_nationkey = 1 then '  ' else r_name end as Borough,
    case when n_nationkey = 2 then null else n_name end as Zone,
    case when n_nationkey = 3 then '' else 'Z' || cast(n_regionkey as varchar) end as service_zone
  from nation join region on n_regionkey = r_regionkey),
trips_fx as (
  select * exclude (file_name), replace(replace(file_name,'yellow_tripdata_',''),'.parquet','') as source_month
  from trips_src),
prep as (
  select * replace (try_cast(passenger_count as int) as passenger_count,
      try_cast(RatecodeID as int) as RatecodeID, try_cast(payment_type as int) as payment_type),
    sha256(concat_ws('|', cast(VendorID as varchar), cast(tpep_pickup_datetime as varchar),
      cast(tpep_dropoff_datetime as varchar), cast(PULocationID as varchar),
      cast(DOLocationID as varchar), cast(total_amount as varchar))) as trip_id,
    strftime(tpep_pickup_datetime,'%Y-%m') as partition_month
  from trips_fx),
judged as (
  select *, (passenger_count is null or passenger_count <= 0 or passenger_count > 9
    or trip_distance <= 0 or fare_amount <= 0
    or tpep_pickup_datetime is null or tpep_dropoff_datetime is null
    or tpep_pickup_datetime >= tpep_dropoff_datetime
    or partition_month <> source_month) as bad from prep),
silver as (select * exclude (bad, source_month) from judged where not bad),
quar as (select * exclude (bad, source_month) from judged where bad),
lost as (select * exclude (bad, source_month) from judged where bad is null),
zjudged as (
  select *, (LocationID is null or LocationID <= 0 or Borough is null or trim(Borough) = ''
    or Zone is null or trim(Zone) = '' or service_zone is null or trim(service_zone) = '') as bad
  from zones_fx),
zsilver as (select * exclude (bad) from zjudged where not bad),
zquar as (select * exclude (bad) from zjudged where bad),
stg_trips as (
  select VendorID as vendor_id, tpep_pickup_datetime as pickup_datetime,
    tpep_dropoff_datetime as dropoff_datetime, passenger_count, trip_distance,
    RatecodeID as rate_code_id, store_and_fwd_flag, PULocationID as pickup_location_id,
    DOLocationID as dropoff_location_id, cast(payment_type as bigint) as payment_type,
    fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge,
    total_amount, congestion_surcharge, airport_fee from silver),
stg_zones as (select LocationID as location_id, Borough as borough, Zone as zone, service_zone from zsilver),
int_null as (
  select t.vendor_id, t.pickup_datetime, t.dropoff_datetime, t.passenger_count, t.trip_distance,
    t.rate_code_id, t.store_and_fwd_flag, t.pickup_location_id,
    p.borough as pickup_borough, p.zone as pickup_zone, p.service_zone as pickup_service_zone,
    t.dropoff_location_id,
    d.borough as dropoff_borough, d.zone as dropoff_zone, d.service_zone as dropoff_service_zone,
    t.payment_type, t.fare_amount, t.extra, t.mta_tax, t.tip_amount, t.tolls_amount,
    t.improvement_surcharge, t.total_amount, t.congestion_surcharge, t.airport_fee
  from stg_trips t left join stg_zones p on t.pickup_location_id = p.location_id
    left join stg_zones d on t.dropoff_location_id = d.location_id),
int_default as (
  select * replace (coalesce(pickup_borough,'') as pickup_borough, coalesce(pickup_zone,'') as pickup_zone,
    coalesce(pickup_service_zone,'') as pickup_service_zone, coalesce(dropoff_borough,'') as dropoff_borough,
    coalesce(dropoff_zone,'') as dropoff_zone, coalesce(dropoff_service_zone,'') as dropoff_service_zone)
  from int_null)
"""

TAILS = {
    "source_month": """
        select file_name, replace(replace(file_name,'yellow_tripdata_',''),'.parquet','') as
        source_month, count(*) as n from trips_src group by 1, 2
        """,
    "align_schema": "select * from trips_fx",
    "union_months": "select source_month, count(*) as n from trips_fx group by 1",
    "narrow_types": """
        select VendorID, passenger_count, RatecodeID, payment_type, count(*) as n from prep
        group by 1, 2, 3, 4
        """,
    "trip_key": "select trip_id, VendorID, total_amount from prep",
    "partition_month": "select partition_month, count(*) as n from prep group by 1",
    "trips_silver": "select * from silver",
    "trips_quarantine": "select * from quar",
    "trips_quarantine_all": """
        select * exclude (bad, source_month) from judged where coalesce(bad, true)
        """,
    "trips_unjudged": "select * from lost",
    "trips_rule_counts": """
        select count(*) filter (passenger_count is null) as passenger_null, count(*) filter
        (passenger_count <= 0) as passenger_le_0, count(*) filter (passenger_count > 9) as
        passenger_gt_9, count(*) filter (trip_distance <= 0) as distance_le_0, count(*) filter
        (fare_amount <= 0) as fare_le_0, count(*) filter (tpep_pickup_datetime is null) as
        pickup_null, count(*) filter (tpep_dropoff_datetime is null) as dropoff_null, count(*)
        filter (tpep_pickup_datetime >= tpep_dropoff_datetime) as pickup_ge_dropoff, count(*)
        filter (partition_month <> source_month) as wrong_month from prep
        """,
    "trips_row_audit": """
        select count(*) as n_read, count(*) filter (not bad) as n_clean, count(*) filter (bad)
        as n_quarantined, count(*) filter (bad is null) as n_unjudged from judged
        """,
    "silver_month_pruned": "select * from silver where partition_month = '1996-03'",
    "silver_month_rewritten": """
        select * exclude (bad, source_month), case when bad then 'quarantine' else 'clean' end
        as verdict from judged where bad is not null
        and not (source_month = '1996-03' and VendorID > 3)
        """,
    "zones_csv": """
        select LocationID, Borough, Zone, nullif(service_zone,'') as service_zone from
        zones_fx
        """,
    "zones_silver": "select * from zsilver",
    "zones_quarantine": "select * from zquar",
    "zones_row_audit": """
        select count(*) as n_read, count(*) filter (not bad) as n_clean, count(*) filter (bad)
        as n_quarantined from zjudged
        """,
    "raw_month_key": """
        select year(tpep_pickup_datetime) * 100 + month(tpep_pickup_datetime) as month_key,
        count(*) as n from silver group by 1
        """,
    "raw_trips_load": """
        select * exclude (trip_id, partition_month) replace (cast(payment_type as bigint) as
        payment_type) from silver
        """,
    "raw_zones_load": "select * from zsilver",
    "raw_load_defaults": """
        select * exclude (trip_id, partition_month, source_month) replace (cast(payment_type as
        bigint) as payment_type, coalesce(tpep_pickup_datetime, timestamp '1970-01-01') as
        tpep_pickup_datetime, coalesce(tpep_dropoff_datetime, timestamp '1970-01-01') as
        tpep_dropoff_datetime, coalesce(trip_distance, 0) as trip_distance,
        coalesce(fare_amount, 0) as fare_amount) from prep
        """,
    "loaded_counts": """
        select 'raw_trips' as table_name, count(*) as n from silver union all
        select 'raw_zones' as table_name, count(*) as n from zsilver
        """,
    "landing_missing": "select distinct file_name from trips_src where file_name not like '%1996-%'",
    "stg_trips": "select * from stg_trips",
    "stg_zones": "select * from stg_zones",
    "int_trips_with_zones": "select * from int_default",
    "int_trips_with_zones_nulls": "select * from int_null",
    "mart_revenue_by_borough": """
        select pickup_borough as borough, count(*) as trip_count, cast(sum(cast(total_amount
        as decimal(18,2))) as double) as total_revenue from int_default group by 1
        """,
    "mart_revenue_by_borough_nulls": """
        select pickup_borough as borough, count(*) as trip_count, cast(sum(cast(total_amount
        as decimal(18,2))) as double) as total_revenue from int_null group by 1
        """,
    "align_drifted": "select * from trips_fx",
    "align_zoned": "select * from trips_fx",
    "bronze_drifted": "select * from trips_fx",
    "bronze_mixed_parts": "select * from trips_fx",
    "landing_audit": """
        select file_name as object_name, count(*) as n_rows, true as verified from trips_src
        group by 1
        """,
    "quarantine_stored": "select * from quar",
    "split_stored_apart": """
        select 'clean' as verdict, partition_month, count(*) as n from silver group by 2 union
        all select 'quarantine' as verdict, partition_month, count(*) as n from quar group by
        2
        """,
    "zones_stored": """
        select *, 'clean' as verdict from zsilver union all select LocationID, Borough, Zone,
        nullif(service_zone,'') as service_zone, 'quarantine' as verdict from zquar
        """,
    "raw_trips_load_ranged": """
        select * exclude (trip_id, partition_month) replace (cast(payment_type as bigint) as
        payment_type) from silver
        """,
    "full_refresh_mart": """
        select pickup_borough as borough, count(*) as trip_count, cast(sum(cast(total_amount
        as decimal(18,2))) as double) as total_revenue from int_default group by 1
        """,
}

# The columns that each of the drifted deliveries is stored with.
_DELIVERED = {
    "VendorID > 4": {"VendorID": None, "airport_fee": None, "vendorid": "integer", "Airport_fee": "double",
                     "passenger_count": "long", "RatecodeID": "string"},
    "VendorID between 2 and 4": {"airport_fee": None},
    "VendorID = 1": {"congestion_surcharge": None},
}
_STORED = {
    "file_name": "string", "VendorID": "long", "tpep_pickup_datetime": "timestamp_ntz",
    "tpep_dropoff_datetime": "timestamp_ntz", "passenger_count": "double", "trip_distance": "double",
    "RatecodeID": "double", "store_and_fwd_flag": "string", "PULocationID": "long", "DOLocationID": "long",
    "payment_type": "long", "fare_amount": "double", "extra": "double", "mta_tax": "double",
    "tip_amount": "double", "tolls_amount": "double", "improvement_surcharge": "double",
    "total_amount": "double", "congestion_surcharge": "double", "airport_fee": "double",
}


def _stored_columns(changes: dict) -> str:
    columns = {n: t for n, t in (_STORED | changes).items() if t and n != "file_name"}
    return ",".join(sorted(f"{n} {t}" for n, t in columns.items()))


TAILS["bronze_schema_groups"] = " union all ".join(
    f"""
        select distinct '{_stored_columns(changes)}' as columns,
          (select count(*) from trips_src where {vendors}) as n_rows, file_name as object_name
        from trips_src where {vendors}
        """
    for vendors, changes in _DELIVERED.items()
)
TAILS["silver_snapshot_read"] = TAILS["trips_silver"]
TAILS["landing_committed"] = """
        select source_month, count(*) as n from trips_fx where source_month like '1996-%' group by 1
        """
TAILS["landing_digests"] = """
        , texts as (
          select file_name, string_agg(line || chr(10), '' order by line) as body from (
            select file_name, concat_ws(',', VendorID, PULocationID, DOLocationID,
              cast(round(total_amount * 100) as bigint)) as line from trips_src)
          group by 1),
        blocks as (
          select file_name, body, unnest(range((length(body) + 4095) // 4096)) as i from texts),
        tree as (
          select file_name, i, (length(body) + 4095) // 4096 as n,
            sha256(substring(body, 4096 * i + 1, 4096)) as digest from blocks
          union all
          select file_name, i // 4 as i, (n + 3) // 4 as n, sha256(string_agg(digest, '' order by i)) as digest
          from tree where n > 1 group by file_name, i // 4, n)
        select file_name, length(body) as n_bytes, digest from texts join tree using (file_name) where n = 1
        """
# Prices are whole multiples of 2**-43; their sum's 53 leading bits are rounded to even.
TAILS["mart_revenue_exact"] = """
        , whole as (
          select pickup_borough as borough, count(*) as trip_count,
            sum(cast(total_amount * 8796093022208 as bigint)::hugeint)::hugeint as s
          from int_default group by 1),
        cut as (
          select *, (1::hugeint << greatest(0, cast(floor(log2(s::double)) as int) - 52)) as unit from whole)
        select borough, trip_count, ((s // unit
            + case when 2 * (s % unit) > unit or 2 * (s % unit) = unit and (s // unit) % 2 = 1 then 1 else 0 end)::double
          * unit::double) / 8796093022208 as total_revenue
        from cut
        """
TAILS["int_trips_skewed"] = TAILS["int_trips_with_zones"]
TAILS["zones_csv_rejects"] = """
        select case n_nationkey when 1 then 'x1,' || n_name || ',' || n_name || ',Z'
            when 2 then '2,' || n_name || ',' || n_name else '3,' || n_name || ',' || n_name || ',Z,more' end as line,
          case n_nationkey when 1 then 'type of a value' else 'number of fields' end as reason
        from nation where n_nationkey in (1, 2, 3)
        """
_REQUIRED = [f.name for f in RAW_TRIPS if not f.nullable]
_BITS = " + ".join(f"case when {name} is null then {1 << i} else 0 end" for i, name in enumerate(_REQUIRED))
TAILS["raw_load_rejects"] = f"select cast({_BITS} as bigint) as broken, count(*) as n from prep group by 1"
TAILS["refresh_one_month"] = TAILS["mart_revenue_exact"].replace(
    "from int_default",
    "from int_default where not (strftime(pickup_datetime, '%Y-%m') = '1996-03' and vendor_id > 3)",
)
TAILS["raw_time_slice"] = f"""{TAILS['raw_trips_load']}
        where tpep_pickup_datetime >= timestamp '1996-03-20' and tpep_pickup_datetime < timestamp '1996-04-05'
        """
TAILS["refresh_registered_again"] = TAILS["full_refresh_mart"]
TAILS["split_audit_stored"] = TAILS["trips_row_audit"]
TAILS["raw_full_refresh_twice"] = TAILS["raw_trips_load"]
TAILS["raw_append_twice"] = f"{TAILS['raw_trips_load']} union all {TAILS['raw_trips_load']}"

ORACLES = {name: f"{BASE}{tail}" for name, tail in TAILS.items()}
ORACLES["landing_digests"] = ORACLES["landing_digests"].replace("with ", "with recursive ", 1)
