"""Bronze-shaped views of the given tables (`lineitem`, `orders`, `supplier`, `nation`, `events`).

The texts run unchanged in Spark and in the SQL used for checking; they fix the
input and hold no engine logic. Each reads its whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stintlake.operators.grouping import row_numbers

LAP_ORDER = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus",
)

KEYED_LINEITEM = """
SELECT t.*, CAST(YEAR(l_shipdate) * 100 + MONTH(l_shipdate) AS BIGINT) AS session_key,
       CAST(l_suppkey % 97 + 1 AS BIGINT) AS driver_number,
       CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS cents
FROM {lineitem} t
"""

LAPS = """
SELECT session_key,
  CAST(FLOOR(session_key / 3) AS BIGINT) AS meeting_key,
  CASE WHEN l_partkey % 991 = 5 THEN NULL ELSE driver_number END AS driver_number,
  CASE WHEN l_orderkey % 997 = 5 THEN NULL ELSE lap_number END AS lap_number,
  CAST(CAST(l_shipdate AS DATE) AS STRING) || 'T0' || CAST(l_linenumber AS STRING)
    || ':00:00+00:00' AS date_start,
  CASE WHEN l_linenumber = 7 THEN NULL ELSE ((cents - cents % 30) / 30) / 1000 END AS lap_duration,
  CASE WHEN l_linenumber = 6 THEN NULL
       ELSE (l_returnflag = 'R' AND l_linestatus = 'F') END AS is_pit_out_lap,
  CASE WHEN l_linenumber IN (5, 7) THEN NULL ELSE l_quantity END AS duration_sector_1,
  CASE WHEN l_linenumber = 7 THEN NULL ELSE ROUND(l_discount * 500, 3) END AS duration_sector_2,
  CASE WHEN l_linenumber IN (3, 7) THEN NULL ELSE ROUND(l_tax * 500, 3) END AS duration_sector_3,
  CASE WHEN l_linenumber = 2 THEN NULL ELSE 200 + CAST(l_partkey % 150 AS INT) END AS i1_speed,
  CASE WHEN l_linenumber = 4 THEN NULL ELSE 180 + CAST(l_orderkey % 170 AS INT) END AS i2_speed,
  CAST(NULL AS INT) AS st_speed,
  l_linenumber,
  CAST(CAST(DATE_TRUNC('month', l_shipdate) AS DATE) AS STRING) AS batch_day,
  'Session ' || CAST(session_key AS STRING) AS session_name,
  CAST(CAST(DATE_TRUNC('year', l_shipdate) AS DATE) AS TIMESTAMP) AS _ingestion_timestamp
FROM {numbered} t
"""

SESSIONS = """
SELECT CASE WHEN p = '2-HIGH' AND m = 7 THEN NULL ELSE session_key END AS session_key,
  CASE p WHEN '1-URGENT' THEN 'Race' WHEN '2-HIGH' THEN 'Sprint Qualifying'
         WHEN '3-MEDIUM' THEN 'Practice 2' WHEN '5-LOW' THEN 'Sprint' END AS session_name,
  CASE p WHEN '1-URGENT' THEN 'Race' WHEN '2-HIGH' THEN 'Qualifying'
         WHEN '3-MEDIUM' THEN 'Practice' WHEN '4-NOT SPECIFIED' THEN 'Test' END AS session_type,
  CASE WHEN p = '3-MEDIUM' AND m = 4 THEN 'not a date'
       WHEN p = '4-NOT SPECIFIED' AND m = 6 THEN NULL
       ELSE CAST(month_day AS STRING) || 'T10:00:00+00:00' END AS date_start,
  CASE WHEN p = '5-LOW' AND m = 9 THEN NULL
       ELSE CAST(month_day AS STRING) || 'T1' || CAST(1 + n % 3 AS STRING) || ':30:00+00:00'
       END AS date_end,
  '00:00:00' AS gmt_offset,
  CAST(FLOOR(session_key / 3) AS BIGINT) AS meeting_key,
  CASE WHEN m = 2 THEN NULL ELSE n_name || ' / Park' END AS location,
  n_nationkey AS country_key,
  'N' || CAST(n_nationkey AS STRING) AS country_code,
  CASE WHEN m = 5 THEN NULL ELSE n_name END AS country_name,
  CAST(session_key % 11 AS BIGINT) AS circuit_key,
  'C' || CAST(session_key % 11 AS STRING) AS circuit_short_name,
  CAST(y AS INT) AS year,
  CAST(month_day + CAST(session_key * CAST(SUBSTR(p, 1, 1) AS INT) % 7 AS INT) AS TIMESTAMP)
    AS _ingestion_timestamp
FROM (SELECT CAST(YEAR(o_orderdate) * 100 + MONTH(o_orderdate) AS BIGINT) AS session_key,
             YEAR(o_orderdate) AS y, MONTH(o_orderdate) AS m, o_orderpriority AS p,
             CAST(MIN(DATE_TRUNC('month', o_orderdate)) AS DATE) AS month_day, COUNT(*) AS n
      FROM {orders} GROUP BY 1, 2, 3, 4) o
JOIN {nation} n ON n.n_nationkey = o.session_key % 25
"""

DRIVERS = """
SELECT session_key,
  CAST(FLOOR(session_key / 3) AS BIGINT) AS meeting_key,
  CASE WHEN d.driver_number = 50 AND flag = 'N' THEN NULL ELSE d.driver_number END AS driver_number,
  CASE WHEN d.driver_number % 3 = 0 THEN NULL ELSE 'B ' || s_name END AS broadcast_name,
  CASE WHEN d.driver_number % 6 = 0 THEN NULL ELSE s_name END AS full_name,
  'D' || CAST(d.driver_number AS STRING) AS name_acronym,
  CASE team WHEN 0 THEN 'Oracle Red Bull Racing' WHEN 1 THEN 'Scuderia FERRARI'
    WHEN 2 THEN 'Mercedes-AMG' WHEN 3 THEN 'McLaren' WHEN 4 THEN 'BWT Alpine'
    WHEN 5 THEN 'Aston Martin Aramco' WHEN 6 THEN 'Williams' WHEN 7 THEN 'Scuderia AlphaTauri'
    WHEN 8 THEN 'Visa Cash App RB' WHEN 9 THEN 'Racing Bulls' WHEN 10 THEN 'Alfa Romeo Sauber'
    WHEN 11 THEN 'Kick Sauber' WHEN 12 THEN 'MoneyGram Haas' WHEN 13 THEN 'Andretti' END AS team_name,
  CASE WHEN team % 4 = 0 THEN NULL ELSE 'C0FFE' || CAST(team % 10 AS STRING) END AS team_colour,
  'First' || CAST(d.driver_number AS STRING) AS first_name,
  CASE WHEN d.driver_number % 9 = 0 THEN NULL ELSE 'Last' || CAST(d.driver_number AS STRING) END
    AS last_name,
  'https://example.org/' || CAST(d.driver_number AS STRING) || '.png' AS headshot_url,
  'N' || CAST(s_nationkey AS STRING) AS country_code,
  CAST(last_day AS TIMESTAMP) AS _ingestion_timestamp
FROM (SELECT session_key, driver_number, l_returnflag AS flag,
             CAST(MAX(l_shipdate) AS DATE) AS last_day,
             (driver_number + CAST(FLOOR(session_key / 100) AS BIGINT) + CASE WHEN l_returnflag = 'R' THEN 7 ELSE 0 END)
               % 15 AS team
      FROM {keyed} k
      WHERE driver_number <> 14 AND NOT (session_key % 100 = 11 AND driver_number % 10 = 3)
      GROUP BY 1, 2, 3, 5) d
JOIN (SELECT s_suppkey % 97 + 1 AS driver_number, MIN(s_name) AS s_name,
             MIN(s_nationkey) AS s_nationkey
      FROM {supplier} GROUP BY 1) s ON s.driver_number = d.driver_number
"""

LOCATIONS = """
SELECT CAST(YEAR(ts) * 10000 + MONTH(ts) * 100 + DAY(ts) AS BIGINT) AS session_key,
  CAST(YEAR(ts) * 100 + MONTH(ts) AS BIGINT) AS meeting_key,
  CASE WHEN event_id % 499 = 3 THEN NULL ELSE CAST(user_id % 97 + 1 AS BIGINT) END AS driver_number,
  REPLACE(CAST(DATE_TRUNC('second', ts) AS STRING), ' ', 'T') || '+00:00' AS date,
  CASE WHEN event_id % 101 = 7 THEN NULL ELSE CAST(ROUND(value * 100) AS INT) END AS x,
  CAST(event_id % 1000 AS INT) AS y,
  CASE WHEN event_id % 7 = 0 THEN NULL
       ELSE CAST(REGEXP_EXTRACT(props, '([0-9]+)', 1) AS INT) END AS z,
  CAST(CAST(ts AS DATE) AS STRING) AS batch_day,
  'Day ' || CAST(CAST(ts AS DATE) AS STRING) AS session_name,
  CAST(CAST(ts AS DATE) AS TIMESTAMP) AS _ingestion_timestamp
FROM {events} t
"""

EVENT_SESSIONS = """
SELECT CAST(YEAR(ts) * 10000 + MONTH(ts) * 100 + DAY(ts) AS BIGINT) AS session_key,
  'Day ' || CAST(CAST(ts AS DATE) AS STRING) AS session_name,
  'Track ' || CAST(DAY(ts) % 5 AS STRING) AS location,
  CASE WHEN DAY(ts) % 4 = 0 THEN 'Race' ELSE 'Practice' END AS session_type,
  YEAR(ts) AS year,
  CAST(CAST(ts AS DATE) AS STRING) || 'T10:00:00+00:00' AS date_start
FROM {events} t GROUP BY 1, 2, 3, 4, 5, 6
"""


def bronze_from_tables(spark: SparkSession, sf_dir: str) -> dict[str, Callable[[], DataFrame]]:
    """Builders of the four bronze tables (and the telemetry sessions) over one data set."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")

    def given(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    def keyed() -> DataFrame:
        return spark.sql(KEYED_LINEITEM, lineitem=given("lineitem"))

    def laps() -> DataFrame:
        numbered = row_numbers(
            keyed(), ["session_key", "driver_number"], [F.col(c) for c in LAP_ORDER], "lap_number"
        )
        rows = spark.sql(LAPS, numbered=numbered)
        code = F.col("l_linenumber").cast("int")
        none = F.lit(None).cast("int")
        return rows.select(
            "*",
            F.array(code, none, F.lit(2048)).alias("segments_sector_1"),
            F.array(code + 2048, F.lit(2051)).alias("segments_sector_2"),
            F.lit(None).cast("array<int>").alias("segments_sector_3"),
        ).drop("l_linenumber")

    return {
        "bronze_sessions": lambda: spark.sql(
            SESSIONS, orders=given("orders"), nation=given("nation")
        ),
        "bronze_drivers": lambda: spark.sql(DRIVERS, keyed=keyed(), supplier=given("supplier")),
        "bronze_laps": laps,
        "bronze_locations": lambda: spark.sql(LOCATIONS, events=given("events")),
        "event_sessions": lambda: spark.sql(EVENT_SESSIONS, events=given("events")),
    }
