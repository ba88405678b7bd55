"""Raw trip feeds derived from the driver's test tables.

The test data has no trip tables. These SQL templates derive the four raw
feeds (yellow, green, ride-hail, zone lookup) from ``lineitem``,
``orders``+``customer``, ``events`` and ``nation``+``region``, injecting every
defect the rules must handle (NULL drop-off, NULL fare, NULL zones,
negative amounts, zero distance, half passenger counts, wrong totals, future
trips, re-delivered rows). The same text runs in Spark and in DuckDB; only
the timestamp literal keyword differs. Engine code never depends on this
module, only on the raw feed schemas.

Money is built from integer cents so both engines produce the same doubles.
"""

from __future__ import annotations

import hashlib
import os
import threading
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from tripflow.files import Store
from tripflow.session import checkpoint_dir
from tripflow.sources.readers import conform, read_feed, read_zone_csv
from tripflow.sources.schemas import RAW_SCHEMAS

SOURCE_TABLES = ("lineitem", "orders", "customer", "events", "nation", "region")

ZONE_SQL = """
select cast(n_nationkey as int) as LocationID,
  case r_name when 'AFRICA' then 'Manhattan' when 'AMERICA' then 'Brooklyn' when 'ASIA' then 'Queens'
              when 'EUROPE' then 'EWR' else 'Staten Island' end as Borough,
  case n_nationkey when 3 then 'Newark Airport' when 2 then 'jfk ' || n_name
                   when 7 then 'LaGuardia ' || n_name else n_name end as Zone,
  case when n_nationkey % 3 = 0 then 'Yellow Zone' when n_nationkey % 3 = 1 then 'Boro Zone' else 'N/A' end as service_zone
from {nation} join {region} on n_regionkey = r_regionkey
"""

YELLOW_SQL = """
with b as (
  select *, case when l_orderkey % 7001 = 13 and l_linenumber = 1 then {TS}'2098-09-11 00:00:00'
                 else {TS}'2024-01-01 00:00:30' + interval '1' minute * (l_orderkey * 37 % 130000) end as pu,
    case when l_partkey % 101 = 0 then null else floor(l_extendedprice / 10) - 200 end as fare_c,
    floor(l_discount * 1000 + 0.5) as extra_c, floor(l_tax * 5000 + 0.5) as tip_c
  from {lineitem}),
c as (
  select b.*, case when l_orderkey % 97 = 0 then null
                   else pu + interval '1' second * (l_partkey % 2900 - 20) end as dof,
    case when l_partkey % 97 = 5 then -1 else 1 end
      * (coalesce(fare_c, 300) + extra_c + tip_c + 400
         + case when l_orderkey % 500 = 0 then 700 else 0 end) as total_c
  from b),
d as (
  select cast(1 + l_linenumber % 2 as int) as VendorID, pu as tpep_pickup_datetime, dof as tpep_dropoff_datetime,
    case when l_partkey % 50 = 0 then null else l_linenumber / 2.0 end as pc,
    l_quantity - 1 as trip_distance, cast(1 + l_linenumber % 7 as int) as RatecodeID,
    cast(case when l_suppkey % 33 = 32 then null else l_suppkey % 28 end as int) as PULocationID,
    cast(case when l_partkey % 40 = 39 then null else l_partkey % 25 end as int) as DOLocationID,
    cast(case when l_orderkey % 11 = 0 then null else l_linenumber % 7 end as int) as payment_type,
    cast(fare_c as double) / 100 as fare_amount, cast(extra_c as double) / 100 as extra, cast(0.5 as double) as mta_tax,
    cast(tip_c as double) / 100 as tip_amount, cast(0 as double) as tolls_amount,
    cast(1 as double) as improvement_surcharge, cast(total_c as double) / 100 as total_amount,
    case when l_partkey % 13 = 0 then null else cast(2.5 as double) end as congestion_surcharge,
    cast(0 as double) as Airport_fee, case when l_linenumber = 7 then 'Y' else 'N' end as store_and_fwd_flag, l_orderkey
  from c)
select VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, cast(pc as double) as passenger_count, trip_distance,
  RatecodeID, PULocationID, DOLocationID, payment_type, fare_amount, extra, mta_tax, tip_amount, tolls_amount,
  improvement_surcharge, total_amount, congestion_surcharge, Airport_fee, store_and_fwd_flag from d
union all
select VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, cast(pc as double), trip_distance,
  RatecodeID, PULocationID, DOLocationID, payment_type, fare_amount, extra, mta_tax, tip_amount + 1, tolls_amount,
  improvement_surcharge, total_amount, congestion_surcharge, Airport_fee, store_and_fwd_flag from d where l_orderkey % 50 = 0
"""

GREEN_SQL = """
select cast(1 + o_custkey % 2 as int) as VendorID,
  {TS}'2024-01-01 00:00:45' + interval '1' minute * (o_orderkey * 41 % 130000) as lpep_pickup_datetime,
  {TS}'2024-01-01 00:00:45' + interval '1' minute * (o_orderkey * 41 % 130000)
    + interval '1' second * (o_orderkey % 3000 - 60) as lpep_dropoff_datetime,
  cast(o_custkey % 5 as double) as passenger_count, cast(o_orderkey % 37 as double) / 4 as trip_distance,
  cast(1 + o_orderkey % 7 as int) as RatecodeID, cast(c_nationkey as int) as PULocationID,
  cast(case when o_orderkey % 45 = 44 then null else o_orderkey % 25 end as int) as DOLocationID,
  cast(1 + o_orderkey % 6 as int) as payment_type, cast(floor(c_acctbal) as double) / 100 as fare_amount,
  cast(0 as double) as extra, cast(0.5 as double) as mta_tax, cast(floor(o_totalprice / 1000) as double) / 100 as tip_amount,
  cast(0 as double) as tolls_amount, cast(null as double) as ehail_fee, cast(1 as double) as improvement_surcharge,
  cast(floor(c_acctbal) + 150 + floor(o_totalprice / 1000) as double) / 100 as total_amount,
  cast(1 + o_orderkey % 3 as int) as trip_type, cast(0 as double) as congestion_surcharge, 'N' as store_and_fwd_flag
from {orders} join {customer} on o_custkey = c_custkey
"""

HVFHV_SQL = """
select case event_type when 'click' then 'HV0003' when 'view' then 'HV0005' when 'purchase' then 'HV0002'
                       when 'signup' then 'HV0004' else 'HV9999' end as hvfhs_license_num,
  'B0' || cast(user_id % 9 as varchar(4)) as dispatching_base_num,
  case when event_id % 4 = 0 then null else 'B0' || cast(user_id % 9 as varchar(4)) end as originating_base_num,
  ts - interval '4' minute as request_datetime,
  case when event_id % 6 = 0 then null else ts - interval '1' minute end as on_scene_datetime,
  ts as pickup_datetime, ts + interval '1' second * (event_id % 3600 - 30) as dropoff_datetime,
  cast(case when user_id % 41 = 40 then null else user_id % 25 end as int) as PULocationID,
  cast(event_id % 25 as int) as DOLocationID, cast(event_id % 53 as double) / 8 as trip_miles,
  cast(event_id % 3600 - 30 as bigint) as trip_time,
  case when event_id % 89 = 0 then null else cast(floor(value * 100 + 0.5) - 100 as double) / 100 end as base_passenger_fare,
  case when event_id % 5 = 0 then null else cast(0.5 as double) end as tolls,
  cast(0.25 as double) as bcf, cast(0.75 as double) as sales_tax,
  case when event_id % 3 = 0 then null else cast(2.75 as double) end as congestion_surcharge,
  cast(0 as double) as airport_fee, case when event_id % 7 = 0 then null else cast(1.5 as double) end as tips,
  cast(floor(value * 50) as double) / 100 as driver_pay, 'N' as shared_request_flag, 'N' as shared_match_flag,
  ' ' as access_a_ride_flag, 'N' as wav_request_flag, 'N' as wav_match_flag
from {events}
"""

FEED_SQL = {"zone": ZONE_SQL, "yellow": YELLOW_SQL, "green": GREEN_SQL, "hvfhv": HVFHV_SQL}
TS_KEYWORD = {"spark": "timestamp_ntz ", "duckdb": "timestamp "}


def feed_sql(feed: str, dialect: str) -> str:
    """The derivation of one raw feed as SQL text over the bare table names."""
    text = FEED_SQL[feed].replace("{TS}", TS_KEYWORD[dialect])
    return text.format(**{t: t for t in SOURCE_TABLES})


def source_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in SOURCE_TABLES}


def raw_feed(spark: SparkSession, sf_dir: str, feed: str,
             tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """One derived raw feed on its declared raw schema."""
    tables = tables or source_tables(spark, sf_dir)
    text = FEED_SQL[feed].replace("{TS}", TS_KEYWORD["spark"])
    used = {t: tables[t] for t in SOURCE_TABLES if "{" + t + "}" in text}
    return conform(spark.sql(text, **used), RAW_SCHEMAS[feed])


def derived_raw_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All four raw feeds as lazy derivations (no files written)."""
    tables = source_tables(spark, sf_dir)
    return {f: raw_feed(spark, sf_dir, f, tables) for f in FEED_SQL}


def _source_fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """Folder name for the derived feeds: source path plus each table's size and mtime,
    so changed source tables never reuse stale derived files."""
    store = Store(spark)
    parts = [sf_dir, *(f"{t}:{store.fingerprint(f'{sf_dir}/{t}.parquet')}" for t in SOURCE_TABLES)]
    return hashlib.sha1("|".join(parts).encode()).hexdigest()[:16]


_MATERIALIZE_LOCK = threading.Lock()


def materialize_raw_feed(spark: SparkSession, sf_dir: str, feed: str) -> str:
    """Write one derived feed once, as a real deployment receives it; its path.

    Trip feeds become Parquet folders, the zone lookup a CSV file with a
    header, under the session's checkpoint folder; a feed already written
    (``_SUCCESS`` present) is reused.
    """
    with _MATERIALIZE_LOCK:   # queries may be called from several threads of one session
        path = os.path.join(checkpoint_dir(spark), "tripflow-raw", _source_fingerprint(spark, sf_dir), feed)
        if not Store(spark).exists(os.path.join(path, "_SUCCESS")):
            df = raw_feed(spark, sf_dir, feed)
            if feed == "zone":
                df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
            else:
                df.write.mode("overwrite").parquet(path)
        return path


def materialize_raw_feeds(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """All feeds, written; feed -> path."""
    return {feed: materialize_raw_feed(spark, sf_dir, feed) for feed in FEED_SQL}


class RawFeeds(Mapping):
    """The raw feeds read from their materialised files (A1 Parquet, A2 CSV), each on first access."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._sf_dir, self._read = spark, sf_dir, {}

    def __getitem__(self, feed: str) -> DataFrame:
        if feed not in self._read:
            if feed not in FEED_SQL:
                raise KeyError(feed)
            path = materialize_raw_feed(self._spark, self._sf_dir, feed)
            self._read[feed] = (read_zone_csv(self._spark, path) if feed == "zone"
                                else read_feed(self._spark, path, RAW_SCHEMAS[feed]))
        return self._read[feed]

    def __iter__(self) -> Iterator[str]:
        return iter(FEED_SQL)

    def __len__(self) -> int:
        return len(FEED_SQL)


def raw_feeds(spark: SparkSession, sf_dir: str) -> RawFeeds:
    return RawFeeds(spark, sf_dir)
