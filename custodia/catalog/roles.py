"""The given test tables in the roles the operators expect, as DataFrames and as SQL.

trips   = lineitem with its order, customer and supplier. A returned line on a
          finished order is a refund (negative amount), a 10 % discount leaves the
          amount unknown (NULL) and an untaxed line has no distance (NULL).
zones   = nation with its region; some_zones lacks one region, so it has orphans.
versions, stage = customers as versioned master data and as incoming changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from custodia.operators.scd2 import VERSION_COLUMNS, Scd2
from custodia.plans.jobs import TripLayout
from custodia.session import ts
from custodia.sources import read_table

AS_OF = "2024-03-01 00:00:00"
TRIPS_AS_OF = "2001-08-01 00:00:00"
LAYOUT = TripLayout()
CUSTOMERS = Scd2("customer_id", ("name", "segment", "nation"), "customer")


_SCHEMAS: dict[str, object] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """One of the given tables; its schema is inferred from the file once per process."""
    path = f"{sf}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return read_table(spark, path, schema=_SCHEMAS[path])


def text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def number(c: Column | str, digits: int | None = None) -> Column:
    value = (F.col(c) if isinstance(c, str) else c).cast("double")
    return value if digits is None else F.round(value, digits)


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + body.strip()


# -- trips and zones --------------------------------------------------------------


def trips(spark: SparkSession, sf: str) -> DataFrame:
    li, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    customer, supplier = table(spark, sf, "customer"), table(spark, sf, "supplier")
    # 18 digits in all, so that the arithmetic stays on machine words
    net = F.col("l_extendedprice").cast("decimal(12,2)") * (1 - F.col("l_discount").cast("decimal(4,2)"))
    refund = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    amount = F.when(F.col("l_discount") == 0.1, F.lit(None)).when(refund, -net).otherwise(net)
    # orders meet customers first, so the line items are shuffled once, by order key
    placed = orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        "o_orderkey", "o_orderdate", "o_orderpriority", "c_nationkey"
    )
    return (
        li.join(placed, li.l_orderkey == placed.o_orderkey)
        .join(supplier, li.l_suppkey == supplier.s_suppkey)
        .select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line_no"),
            F.col("l_partkey").alias("part_id"),
            F.col("l_suppkey").alias("vendor_id"),
            F.col("o_orderdate").alias("pickup_ts"),
            F.col("l_shipdate").alias("dropoff_ts"),
            F.when(F.col("l_tax") > 0, F.col("l_quantity")).alias("trip_distance"),
            F.col("l_extendedprice").alias("fare_amount"),
            amount.cast("decimal(18,4)").alias("total_amount"),
            F.substring("o_orderpriority", 1, 1).cast("int").alias("payment_type"),
            F.col("c_nationkey").alias("pu_zone_id"),
            F.col("s_nationkey").alias("do_zone_id"),
        )
    )


TRIPS = """
trips AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_partkey AS part_id, l_suppkey AS vendor_id,
         o_orderdate AS pickup_ts, l_shipdate AS dropoff_ts,
         CASE WHEN l_tax > 0 THEN l_quantity END AS trip_distance,
         l_extendedprice AS fare_amount,
         CAST(CASE WHEN l_discount = 0.1 THEN NULL
              WHEN l_returnflag = 'R' AND l_linestatus = 'F'
              THEN -(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))))
              ELSE CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
              END AS DECIMAL(18,4)) AS total_amount,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS payment_type,
         c_nationkey AS pu_zone_id, s_nationkey AS do_zone_id
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey)
"""


def zones(spark: SparkSession, sf: str) -> DataFrame:
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    service = (
        F.when(F.col("r_name") == "AFRICA", "Boro Zone")
        .when(F.col("r_name") == "AMERICA", "Yellow Zone")
        .when(F.col("r_name") == "ASIA", "EWR")
        .when(F.col("r_name") == "EUROPE", " ewr ")
    )
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("location_id"),
        F.col("r_name").alias("borough"),
        F.col("n_name").alias("zone"),
        service.alias("service_zone"),
    )


ZONES = """
zones AS (
  SELECT n_nationkey AS location_id, r_name AS borough, n_name AS zone,
         CASE r_name WHEN 'AFRICA' THEN 'Boro Zone' WHEN 'AMERICA' THEN 'Yellow Zone'
                     WHEN 'ASIA' THEN 'EWR' WHEN 'EUROPE' THEN ' ewr ' END AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey)
"""


def some_zones(spark: SparkSession, sf: str) -> DataFrame:
    """A lookup that lost one borough: its zones are orphans in the trips."""
    return zones(spark, sf).filter("borough <> 'EUROPE'")


SOME_ZONES = "some_zones AS (SELECT * FROM zones WHERE borough <> 'EUROPE')"

PASSES = (
    "pickup_ts <= dropoff_ts AND COALESCE(trip_distance, 0) >= 0 AND COALESCE(total_amount, 0) >= 0"
)

DAILY = """
daily AS (
  SELECT CAST(pickup_ts AS DATE) AS trip_date, pu_zone_id,
         MAX(zone) AS "PU_zone", MAX(borough) AS "PU_borough", COUNT(*) AS trip_count,
         SUM(COALESCE(total_amount, 0)) AS total_revenue,
         SUM(COALESCE(trip_distance, 0)) / COUNT(*) AS avg_distance
  FROM trips LEFT JOIN zones ON pu_zone_id = location_id
  WHERE """ + PASSES + """
  GROUP BY 1, 2)
"""

# -- versioned customers ----------------------------------------------------------


def _segment() -> Column:
    return F.when(F.col("c_acctbal") >= 500, F.col("c_mktsegment"))


def versions(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with a balance below 9000 as SCD2 table; debtors have an expired first version."""
    base = table(spark, sf, "customer").join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).filter("c_acctbal < 9000")
    debtor = F.col("c_acctbal") < 0
    approved = F.col("c_mktsegment") != "MACHINERY"
    known = {
        "is_rollback": F.lit(False),
        "created_by": F.lit("system"),
        "change_source": F.lit("LOAD"),
        "change_batch_id": F.lit("B1"),
    }

    def rows(**values: Column) -> list[Column]:
        have = {**known, **values}
        return [
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("name"),
            values["segment"].alias("segment"),
            F.col("n_name").alias("nation"),
            *[have.get(n, F.lit(None)).cast(t).alias(n) for n, t in VERSION_COLUMNS],
        ]

    first = base.filter(debtor).select(
        *rows(
            segment=F.lit("LEGACY"),
            version_number=F.lit(1),
            effective_from=ts("2023-06-01 00:00:00"),
            effective_to=ts("2024-01-01 00:00:00"),
            is_current=F.lit(False),
            created_at=ts("2023-06-01 00:00:00"),
            approval_status=F.lit("APPROVED"),
            approved_by=F.lit("steward"),
            approved_at=ts("2023-06-02 00:00:00"),
        )
    )
    current = base.select(
        *rows(
            segment=_segment(),
            version_number=F.when(debtor, 2).otherwise(1),
            effective_from=ts("2024-01-01 00:00:00"),
            is_current=F.lit(True),
            created_at=ts("2024-01-01 00:00:00"),
            approval_status=F.when(approved, "APPROVED").otherwise("PENDING"),
            approved_by=F.when(approved, "steward"),
            approved_at=F.when(approved, ts("2024-01-02 00:00:00")),
        )
    )
    return first.unionByName(current)


VERSIONS = """
versions AS (
  SELECT c_custkey AS customer_id, c_name AS name, 'LEGACY' AS segment, n_name AS nation,
         1 AS version_number, TIMESTAMP '2023-06-01' AS effective_from,
         CAST(TIMESTAMP '2024-01-01' AS TIMESTAMP) AS effective_to, FALSE AS is_current,
         TIMESTAMP '2023-06-01' AS created_at, 'system' AS created_by,
         CAST(TIMESTAMP '2023-06-02' AS TIMESTAMP) AS approved_at, 'steward' AS approved_by,
         'APPROVED' AS approval_status, CAST(NULL AS VARCHAR) AS change_reason, 'LOAD' AS change_source,
         'B1' AS change_batch_id, FALSE AS is_rollback, CAST(NULL AS INTEGER) AS rollback_from_version
  FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal < 0
  UNION ALL
  SELECT c_custkey, c_name, CASE WHEN c_acctbal >= 500 THEN c_mktsegment END, n_name,
         CASE WHEN c_acctbal < 0 THEN 2 ELSE 1 END, TIMESTAMP '2024-01-01', NULL, TRUE,
         TIMESTAMP '2024-01-01', 'system',
         CASE WHEN c_mktsegment <> 'MACHINERY' THEN TIMESTAMP '2024-01-02' END,
         CASE WHEN c_mktsegment <> 'MACHINERY' THEN 'steward' END,
         CASE WHEN c_mktsegment <> 'MACHINERY' THEN 'APPROVED' ELSE 'PENDING' END,
         NULL, 'LOAD', 'B1', FALSE, NULL
  FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal < 9000)
"""


def stage(spark: SparkSession, sf: str) -> DataFrame:
    """Incoming customers: renamed, emptied, filled and unchanged segments; deep debtors are absent."""
    base = table(spark, sf, "customer").join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    seg = (
        F.when(F.col("c_mktsegment") == "BUILDING", "CONSTRUCTION")
        .when(F.col("c_mktsegment") == "FURNITURE", F.lit(None))
        .when(F.col("c_acctbal") >= 400, F.col("c_mktsegment"))
    )
    return base.filter("c_acctbal > -500").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        seg.alias("segment"),
        F.col("n_name").alias("nation"),
        F.when(F.col("c_mktsegment") == "BUILDING", "segment renamed").alias("change_reason"),
        F.lit(None).cast("string").alias("change_source"),
        F.lit("B2").alias("change_batch_id"),
    )


STAGE = """
stage AS (
  SELECT c_custkey AS customer_id, c_name AS name,
         CASE WHEN c_mktsegment = 'BUILDING' THEN 'CONSTRUCTION'
              WHEN c_mktsegment = 'FURNITURE' THEN NULL
              WHEN c_acctbal >= 400 THEN c_mktsegment END AS segment,
         n_name AS nation,
         CASE WHEN c_mktsegment = 'BUILDING' THEN 'segment renamed' END AS change_reason,
         CAST(NULL AS VARCHAR) AS change_source, 'B2' AS change_batch_id
  FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > -500)
"""

CHANGES = """
cur AS (SELECT * FROM versions WHERE is_current),
chg AS (
  SELECT s.*, c.customer_id IS NULL AS is_new, COALESCE(c.version_number, 0) AS old_version
  FROM stage s LEFT JOIN cur c ON s.customer_id = c.customer_id
  WHERE c.customer_id IS NULL
     OR s.name IS DISTINCT FROM c.name OR s.segment IS DISTINCT FROM c.segment
     OR s.nation IS DISTINCT FROM c.nation)
"""


def approvals(spark: SparkSession, sf: str) -> DataFrame:
    """Approval requests for all MACHINERY customers, with and without a current version."""
    return (
        table(spark, sf, "customer")
        .filter("c_mktsegment = 'MACHINERY'")
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.lit("owner").alias("approver"),
            F.lit("quarterly review").alias("reason"),
        )
    )


def rollbacks(spark: SparkSession, sf: str) -> DataFrame:
    """Rollback requests to version 1 for debtors (exists) and rich customers (no such key)."""
    return (
        table(spark, sf, "customer")
        .filter("c_acctbal < 0 OR c_acctbal > 9500")
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.lit(1).alias("target_version"),
            F.lit("steward").alias("actor"),
            F.lit("bad load").alias("reason"),
        )
    )


def show_versions(df: DataFrame) -> DataFrame:
    """Version rows with comparable types: times and nullable numbers as text."""
    as_text = ("effective_from", "effective_to", "created_at", "approved_at", "rollback_from_version")
    return df.select(*[text(c).alias(c) if c in as_text else F.col(c) for c in CUSTOMERS.columns])


SHOW_VERSIONS = """
customer_id, name, segment, nation, version_number, CAST(effective_from AS VARCHAR) AS effective_from,
CAST(effective_to AS VARCHAR) AS effective_to, is_current, CAST(created_at AS VARCHAR) AS created_at, created_by,
CAST(approved_at AS VARCHAR) AS approved_at, approved_by, approval_status, change_reason, change_source,
change_batch_id, is_rollback, CAST(rollback_from_version AS VARCHAR) AS rollback_from_version
"""

# -- suppliers as type-1 master ---------------------------------------------------


def supplier_master(spark: SparkSession, sf: str) -> DataFrame:
    """Known suppliers (balance below 8000) with audit columns."""
    return table(spark, sf, "supplier").filter("s_acctbal < 8000").select(
        F.col("s_suppkey").alias("vendor_id"),
        F.col("s_name").alias("vendor_name"),
        F.col("s_nationkey").alias("location_id"),
        F.lit(1).alias("version"),
        ts("2024-01-01 00:00:00").alias("created_at"),
        F.lit("loader").alias("created_by"),
        ts("2024-01-01 00:00:00").alias("updated_at"),
        F.lit("loader").alias("updated_by"),
        F.lit(None).cast("timestamp_ntz").alias("approved_at"),
        F.lit(None).cast("string").alias("approved_by"),
    )


SUPPLIER_MASTER = """
master AS (
  SELECT s_suppkey AS vendor_id, s_name AS vendor_name, s_nationkey AS location_id, 1 AS version,
         TIMESTAMP '2024-01-01' AS created_at, 'loader' AS created_by,
         TIMESTAMP '2024-01-01' AS updated_at, 'loader' AS updated_by,
         CAST(NULL AS TIMESTAMP) AS approved_at, CAST(NULL AS VARCHAR) AS approved_by
  FROM supplier WHERE s_acctbal < 8000)
"""


def supplier_incoming(spark: SparkSession, sf: str) -> DataFrame:
    """Solvent suppliers, the ones of a large balance under an upper-case name."""
    name = F.when(F.col("s_acctbal") > 5000, F.upper("s_name")).otherwise(F.col("s_name"))
    return table(spark, sf, "supplier").filter("s_acctbal > 0").select(
        F.col("s_suppkey").alias("vendor_id"), name.alias("vendor_name"), F.col("s_nationkey").alias("location_id")
    )


SUPPLIER_INCOMING = """
incoming AS (
  SELECT s_suppkey AS vendor_id, CASE WHEN s_acctbal > 5000 THEN upper(s_name) ELSE s_name END AS vendor_name,
         s_nationkey AS location_id
  FROM supplier WHERE s_acctbal > 0)
"""


def lifecycle(spark: SparkSession, sf: str) -> DataFrame:
    """States of known suppliers: debtors are deprecated, suppliers above 6000 have none yet."""
    state = F.when(F.col("s_acctbal") < 0, "DEPRECATED").when(F.col("s_acctbal") < 500, "PROPOSED").otherwise("ACTIVE")
    return table(spark, sf, "supplier").filter("s_acctbal < 6000").select(
        F.col("s_suppkey").alias("vendor_id"),
        state.alias("lifecycle_state"),
        F.lit("load").alias("state_reason"),
        ts("2024-01-01 00:00:00").alias("updated_at"),
        F.lit("loader").alias("updated_by"),
    )


LIFECYCLE = """
lifecycle AS (
  SELECT s_suppkey AS vendor_id,
         CASE WHEN s_acctbal < 0 THEN 'DEPRECATED' WHEN s_acctbal < 500 THEN 'PROPOSED' ELSE 'ACTIVE' END AS lifecycle_state,
         'load' AS state_reason, TIMESTAMP '2024-01-01' AS updated_at, 'loader' AS updated_by
  FROM supplier WHERE s_acctbal < 6000)
"""
