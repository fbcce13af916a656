"""Delivery tables derived from the order, line item and event tables.

Each view exists twice, as DataFrame expressions and as SQL text, built from
multiplication, modulo and CASE so that two engines agree bit for bit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PING_GAP_MIN = 600.0
MIN_PINGS = 5
MIN_DRIVER_STOPS = 600

# Fixed values of the stand-in views.
VEHICLES = ("van", "truck", "cargo_bike")
REGIONS = ("Center", "North", "South-East", "West")
WINDOWS = ("morning_peak", "afternoon_peak", "midday", "early", "evening")

ROUTES_SQL = """
routes AS (
  SELECT o_orderkey AS route_id,
         CAST(o_custkey % 80 AS VARCHAR) AS vehicle_id,
         CASE o_orderkey % 3 WHEN 0 THEN 'van' WHEN 1 THEN 'truck' ELSE 'cargo_bike' END AS vehicle_type,
         CAST(o_custkey % 40 AS VARCHAR) AS driver_id,
         CASE o_orderstatus WHEN 'F' THEN 'A' WHEN 'O' THEN 'B' ELSE 'C' END AS depot,
         CASE WHEN (o_orderkey // 3) % 2 = 0 THEN 'fifo' ELSE 'cluster_nn' END AS algorithm,
         CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'morning_peak' WHEN '2' THEN 'afternoon_peak'
              WHEN '3' THEN 'midday' WHEN '4' THEN 'early' ELSE 'evening' END AS dispatch_window,
         r_name AS region,
         o_orderdate AS dispatch_planned,
         o_orderdate + to_microseconds(CAST(floor(u*u*u*u*u*u/600 * 60000000) AS BIGINT)) AS dispatch_actual,
         u*u*u*u*u*u/600 AS wait_min,
         1 + o_orderkey % 7 AS n_stops,
         5 + CAST(o_orderkey * 7919 % 3500 AS DOUBLE) / 100 AS route_km,
         0.5::DOUBLE AS late_rate
  FROM (SELECT *, o_totalprice / 100000 AS u FROM orders)
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
)"""

STOPS_SQL = """
stops AS (
  SELECT l_orderkey AS route_id,
         CAST(l_linenumber AS BIGINT) AS stop_seq,
         52.45::DOUBLE + CAST(l_partkey % 4 AS DOUBLE) * 0.04::DOUBLE
           + CAST(l_suppkey % 3 AS DOUBLE) * 0.0005::DOUBLE AS lat,
         13.3::DOUBLE + CAST(l_partkey % 3 AS DOUBLE) * 0.06::DOUBLE
           + CAST(l_suppkey % 5 AS DOUBLE) * 0.0005::DOUBLE AS lon,
         CASE l_suppkey % 4 WHEN 0 THEN 'Center' WHEN 1 THEN 'North' WHEN 2 THEN 'South-East' ELSE 'West' END AS region,
         l_shipdate AS planned_arrival,
         l_shipdate + to_microseconds(CAST(floor((l_quantity * 0.8::DOUBLE - 10) * 60000000) AS BIGINT)) AS actual_arrival,
         l_quantity * 0.8::DOUBLE - 10 AS delay_min,
         l_returnflag = 'R' AS is_late,
         l_discount * 100 AS service_min
  FROM lineitem
)"""

PING_ROUTES_SQL = """
ping_routes AS (
  SELECT c_custkey AS route_id,
         CASE c_custkey % 3 WHEN 0 THEN 'van' WHEN 1 THEN 'truck' ELSE 'cargo_bike' END AS vehicle_type,
         CASE c_custkey % 4 WHEN 0 THEN 'Center' WHEN 1 THEN 'North' WHEN 2 THEN 'South-East' ELSE 'West' END AS region
  FROM customer
)"""

PINGS_SQL = """
pings AS (
  SELECT user_id AS route_id, ts,
         52.45::DOUBLE + CAST(user_id % 4 AS DOUBLE) * 0.04::DOUBLE
           + CAST(event_id % 3 AS DOUBLE) * 0.0005::DOUBLE AS lat,
         13.3::DOUBLE + CAST(user_id % 3 AS DOUBLE) * 0.06::DOUBLE
           + CAST(event_id % 5 AS DOUBLE) * 0.0005::DOUBLE AS lon,
         value AS speed_kmh,
         CASE WHEN event_type IN ('view', 'click') THEN 1 WHEN event_type = 'purchase' THEN 2 ELSE 0 END AS status
  FROM events
)"""


def _read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _pick(number: Column, names: tuple[str, ...]) -> Column:
    """names[number] for number in 0..len-1."""
    choice = F.when(number == 0, names[0])
    for i, name in enumerate(names[1:-1], 1):
        choice = choice.when(number == i, name)
    return choice.otherwise(names[-1])


def _plus_minutes(ts: str, minutes: Column) -> Column:
    micros = F.floor(minutes * 60_000_000).cast("long")
    return F.timestamp_add("MICROSECOND", micros, F.col(ts))


def _position(a: Column, b: Column) -> dict[str, Column]:
    return {
        "lat": F.lit(52.45) + (a % 4).cast("double") * 0.04 + (b % 3).cast("double") * 0.0005,
        "lon": F.lit(13.3) + (a % 3).cast("double") * 0.06 + (b % 5).cast("double") * 0.0005,
    }


def _columns(**columns: Column) -> list[Column]:
    return [c.alias(name) for name, c in columns.items()]


def routes(spark: SparkSession, folder: str) -> DataFrame:
    # Nations and regions are fixed tables of 25 and 5 rows; customers grow with the
    # data, so that join is left to the planner.
    joined = (
        _read(spark, folder, "orders")
        .join(_read(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(_read(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(_read(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    key, u = F.col("o_orderkey"), F.col("o_totalprice") / 100000
    wait = u * u * u * u * u * u / 600
    status = F.col("o_orderstatus")
    return joined.select(
        *_columns(
            route_id=key,
            vehicle_id=(F.col("o_custkey") % 80).cast("string"),
            vehicle_type=_pick(key % 3, VEHICLES),
            driver_id=(F.col("o_custkey") % 40).cast("string"),
            depot=F.when(status == "F", "A").when(status == "O", "B").otherwise("C"),
            algorithm=F.when(F.floor(key / 3) % 2 == 0, "fifo").otherwise("cluster_nn"),
            dispatch_window=_pick(
                F.substring("o_orderpriority", 1, 1).cast("int") - 1, WINDOWS
            ),
            region=F.col("r_name"),
            dispatch_planned=F.col("o_orderdate"),
            dispatch_actual=_plus_minutes("o_orderdate", wait),
            wait_min=wait,
            n_stops=1 + key % 7,
            route_km=5 + (key * 7919 % 3500).cast("double") / 100,
            late_rate=F.lit(0.5),
        )
    )


def stops(spark: SparkSession, folder: str) -> DataFrame:
    delay = F.col("l_quantity") * 0.8 - 10
    return _read(spark, folder, "lineitem").select(
        *_columns(
            route_id=F.col("l_orderkey"),
            stop_seq=F.col("l_linenumber").cast("long"),
            **_position(F.col("l_partkey"), F.col("l_suppkey")),
            region=_pick(F.col("l_suppkey") % 4, REGIONS),
            planned_arrival=F.col("l_shipdate"),
            actual_arrival=_plus_minutes("l_shipdate", delay),
            delay_min=delay,
            is_late=F.col("l_returnflag") == "R",
            service_min=F.col("l_discount") * 100,
        )
    )


def ping_routes(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    return _read(spark, folder, "customer").select(
        *_columns(
            route_id=key,
            vehicle_type=_pick(key % 3, VEHICLES),
            region=_pick(key % 4, REGIONS),
        )
    )


def pings(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    status = F.when(kind.isin("view", "click"), 1).when(kind == "purchase", 2).otherwise(0)
    return _read(spark, folder, "events").select(
        *_columns(
            route_id=F.col("user_id"),
            ts=F.col("ts"),
            **_position(F.col("user_id"), F.col("event_id")),
            speed_kmh=F.col("value"),
            status=status,
        )
    )
