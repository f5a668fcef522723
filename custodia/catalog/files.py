"""Queries: reading, writing and re-reading tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from custodia.catalog.roles import TRIPS, number, table, text, trips, with_ctes
from custodia.operators import align
from custodia.session import work_dir
from custodia.sources import (
    append_batched, create_partitioned_table, keep_columns, load_columns, read_declared_partitions, read_lookup,
    read_partitions, read_table, write_flat, write_partitioned,
)

ENTRIES = {}


def entry(name, sql=None):
    def add(fn):
        ENTRIES[name] = (fn, sql)
        return fn

    return add


@entry(
    "read_align",
    """SELECT o_orderkey AS order_id, CAST(o_orderkey AS INTEGER) AS order_int,
       CAST(TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS VARCHAR) AS code,
       CAST(TRY_CAST(o_orderpriority AS INTEGER) AS VARCHAR) AS not_a_code,
       strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders""",
)
def read_align(spark, sf):
    raw = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderkey").alias("order_int"), F.substring("o_orderpriority", 1, 1).alias("code"),
        F.col("o_orderpriority").alias("not_a_code"), text("o_orderdate").alias("day"),
    )
    cast = align.cast_columns(raw, {"order_int": "int", "code": "int", "not_a_code": "int", "day": "date", "absent": "int"})
    named = align.rename(cast, {"o_orderkey": "order_id"})
    return named.withColumns({"code": text("code"), "not_a_code": text("not_a_code"), "day": text("day")})


@entry(
    "lookup_read",
    """SELECT CAST(c_custkey AS VARCHAR) AS location_id, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS borough,
       c_name AS zone FROM customer""",
)
def lookup_read(spark, sf):
    """Customers written as a header CSV with a marker for NULL, read back with that marker."""
    path = work_dir(spark, "lookup")
    borough = F.when(F.col("c_acctbal") < 0, "N/A").otherwise(F.col("c_mktsegment"))
    source = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("LocationID"), borough.alias("Borough"), F.col("c_name").alias("Zone")
    )
    source.write.option("header", True).option("quoteAll", True).csv(path)
    back = read_lookup(spark, path, ["LocationID", "Borough", "Zone"], "LocationID", "int", ["N/A"])
    named = align.rename(back, {"LocationID": "location_id", "Borough": "borough", "Zone": "zone"})
    return named.withColumn("location_id", text("location_id"))


@entry("column_subset", "SELECT l_orderkey, l_quantity, l_shipmode_missing_ok AS l_returnflag FROM (SELECT l_orderkey, l_quantity, l_returnflag AS l_shipmode_missing_ok FROM lineitem)")
def column_subset(spark, sf):
    return read_table(spark, f"{sf}/lineitem.parquet", ["l_orderkey", "l_quantity", "l_shipmode", "l_returnflag"])


ORDERS_BY_MONTH = """SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate,
       year(o_orderdate) AS year, month(o_orderdate) AS month FROM orders"""


def dated(df):
    return df.select(
        "o_orderkey", "o_custkey", "o_totalprice", text("o_orderdate").alias("o_orderdate"), "year", "month"
    )


@entry("partitioned_roundtrip", ORDERS_BY_MONTH)
def partitioned_roundtrip(spark, sf):
    path = work_dir(spark, "partitioned")
    write_partitioned(align.add_year_month(table(spark, sf, "orders"), "o_orderdate"), path, ["year", "month"], "o_orderdate")
    return dated(spark.read.parquet(path))


@entry("ctas_partitioned", ORDERS_BY_MONTH)
def ctas_partitioned(spark, sf):
    name = f"orders_part_{uuid.uuid4().hex}"
    return dated(create_partitioned_table(spark, table(spark, sf, "orders"), name, work_dir(spark, "ctas"), "o_orderdate"))


@entry("declared_partitions", ORDERS_BY_MONTH + " WHERE year(o_orderdate) BETWEEN 1997 AND 1999 AND month(o_orderdate) BETWEEN 1 AND 12")
def declared_partitions(spark, sf):
    path = work_dir(spark, "declared")
    write_partitioned(align.add_year_month(table(spark, sf, "orders"), "o_orderdate"), path, ["year", "month"])
    return dated(read_declared_partitions(spark, path, {"year": (1997, 1999), "month": (1, 12)}))


@entry("partition_filter", ORDERS_BY_MONTH + " WHERE year(o_orderdate) = 1998 AND month(o_orderdate) = 8")
def partition_filter(spark, sf):
    path = work_dir(spark, "filtered")
    write_partitioned(align.add_year_month(table(spark, sf, "orders"), "o_orderdate"), path, ["year", "month"])
    return dated(read_partitions(spark, path, ["year", "month"], {"year": 1998, "month": 8}))


@entry(
    "flat_roundtrip",
    with_ctes(TRIPS, body="""
SELECT order_id, line_no, part_id, trip_distance, CAST(total_amount AS DOUBLE) AS total_amount FROM trips"""),
)
def flat_roundtrip(spark, sf):
    path = work_dir(spark, "flat")
    write_flat(keep_columns(trips(spark, sf), ["order_id", "line_no", "part_id", "trip_distance", "total_amount"]), path)
    return spark.read.parquet(path).withColumn("total_amount", number("total_amount"))


@entry(
    "column_load",
    """SELECT l_orderkey AS trip_id, CAST(l_shipdate AS VARCHAR) AS dropoff_ts, l_extendedprice AS fare_amount FROM lineitem
UNION ALL SELECT o_orderkey, CAST(o_orderdate AS VARCHAR), o_totalprice FROM orders""",
)
def column_load(spark, sf):
    """Two loads of mapped columns into one fact folder."""
    path = work_dir(spark, "fact")
    load_columns(
        table(spark, sf, "lineitem"),
        {"trip_id": "l_orderkey", "dropoff_ts": "l_shipdate", "fare_amount": "l_extendedprice"}, path,
    )
    load_columns(
        table(spark, sf, "orders"), {"trip_id": "o_orderkey", "dropoff_ts": "o_orderdate", "fare_amount": "o_totalprice"}, path
    )
    return spark.read.parquet(path).withColumn("dropoff_ts", text("dropoff_ts"))


@entry("batch_append", "SELECT c_custkey, c_name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def batch_append(spark, sf):
    name, path = f"appended_{uuid.uuid4().hex}", work_dir(spark, "appended")
    append_batched(table(spark, sf, "customer").select("c_custkey", "c_name"), name, path=path)
    more = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_name"))
    append_batched(more, name, path=path)
    return spark.table(name)
