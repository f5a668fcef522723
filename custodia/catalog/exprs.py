"""Queries: scalar expressions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from custodia.catalog.matching import PAYMENT_LABELS
from custodia.catalog.roles import VERSIONS, ZONES, table, text, versions, with_ctes, zones
from custodia.functions import (
    code_label, date_attributes, iso_timestamp, json_number, normalize_party, normalize_place, pass_fail, row_hash,
    score_band, to_document,
)
from custodia.session import clock

ENTRIES = {}


def entry(name, sql=None):
    def add(fn):
        ENTRIES[name] = (fn, sql)
        return fn

    return add


@entry(
    "date_and_null_exprs",
    """SELECT l_orderkey, l_linenumber, l_partkey, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS day, year(l_shipdate) AS year,
       month(l_shipdate) AS month, day(l_shipdate) AS day_of_month, dayofweek(l_shipdate) AS day_of_week,
       CAST(CAST(date_trunc('month', l_shipdate) AS DATE) AS VARCHAR) AS month_start,
       COALESCE(NULLIF(l_quantity, 1.0), 0.0) AS quantity, least(l_discount, l_tax) AS low, greatest(l_discount, l_tax) AS high
FROM lineitem""",
)
def date_and_null_exprs(spark, sf):
    attrs = date_attributes("l_shipdate")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", text(F.to_date("l_shipdate")).alias("day"),
        attrs["year"].alias("year"), attrs["month"].alias("month"), attrs["day"].alias("day_of_month"),
        attrs["day_of_week"].alias("day_of_week"), text(F.trunc("l_shipdate", "MM")).alias("month_start"),
        F.coalesce(F.nullif("l_quantity", F.lit(1.0)), F.lit(0.0)).alias("quantity"),
        F.least("l_discount", "l_tax").alias("low"), F.greatest("l_discount", "l_tax").alias("high"),
    )


@entry(
    "code_map",
    """SELECT l_linenumber, CASE l_linenumber WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No charge'
       WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown' WHEN 6 THEN 'Voided trip' ELSE 'PaymentType ' || l_linenumber END AS label,
       'Vendor ' || l_suppkey AS vendor, COUNT(*) AS rows FROM lineitem GROUP BY 1, 2, 3""",
)
def code_map(spark, sf):
    return table(spark, sf, "lineitem").groupBy(
        "l_linenumber", code_label("l_linenumber", PAYMENT_LABELS, "PaymentType").alias("label"),
        code_label("l_suppkey", {}, "Vendor").alias("vendor"),
    ).agg(F.count("*").alias("rows"))


@entry(
    "allowed_set",
    with_ctes(ZONES, body="""
SELECT location_id, service_zone, lower(trim(service_zone)) AS normalized,
       COALESCE(lower(trim(service_zone)) NOT IN ('boro zone', 'yellow zone'), FALSE) AS outside, n_customers
FROM zones JOIN (SELECT c_nationkey, COUNT(*) AS n_customers FROM customer GROUP BY 1) ON c_nationkey = location_id"""),
)
def allowed_set(spark, sf):
    from custodia.operators.quality import AllowedValues

    rule = AllowedValues("service", "service_zone", ("boro zone", "yellow zone"))
    used = table(spark, sf, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n_customers"))
    z = zones(spark, sf)
    return z.join(used, z.location_id == used.c_nationkey).select(
        "location_id", "service_zone", F.lower(F.trim("service_zone")).alias("normalized"),
        rule.violation().alias("outside"), "n_customers",
    )


@entry(
    "row_hash",
    with_ctes(VERSIONS, body="""
SELECT customer_id, version_number, sha256(concat_ws('||', COALESCE(name, chr(1)), COALESCE(segment, chr(1)), COALESCE(nation, chr(1)))) AS attr_hash
FROM versions"""),
)
def row_hash_query(spark, sf):
    return versions(spark, sf).select(
        "customer_id", "version_number", row_hash(["name", "segment", "nation"]).alias("attr_hash")
    )


MESSY = "'  ' || upper(p_name) || ' - ' || p_brand || ',  ' || p_type || ' !'"


@entry(
    "normalize_text",
    f"""SELECT p_partkey,
       regexp_replace(regexp_replace(lower(trim(t)), '\\s+', ' ', 'g'), '[^a-z0-9 ]', '', 'g') AS place,
       regexp_replace(regexp_replace(trim(lower(t)), '[^a-z0-9\\s]', '', 'g'), '\\s+', ' ', 'g') AS party
FROM (SELECT p_partkey, {MESSY} AS t FROM part)""",
)
def normalize_text(spark, sf):
    messy = F.concat(
        F.lit("  "), F.upper("p_name"), F.lit(" - "), F.col("p_brand"), F.lit(",  "), F.col("p_type"), F.lit(" !")
    )
    return table(spark, sf, "part").select(
        "p_partkey", normalize_place(messy).alias("place"), normalize_party(messy).alias("party")
    )


@entry(
    "score_class",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_discount, CASE WHEN l_discount * 10 >= 0.95 THEN 'AUTO_MERGE'
       WHEN l_discount * 10 >= 0.8 THEN 'STEWARD_REVIEW' ELSE 'MANUAL' END AS label FROM lineitem""",
)
def score_class(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_discount",
        score_band(F.col("l_discount") * 10, 0.95, 0.8).alias("label"),
    )


@entry(
    "status_case",
    """SELECT l_returnflag, l_linestatus, COUNT(*) FILTER (WHERE l_discount > 0.09) AS bad_count,
       CASE WHEN COUNT(*) FILTER (WHERE l_discount > 0.09) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM lineitem GROUP BY 1, 2""",
)
def status_case(spark, sf):
    bad = F.count_if(F.col("l_discount") > 0.09)
    return table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        bad.alias("bad_count"), pass_fail(bad == 0).alias("status")
    )


@entry("json_document", "SELECT c_custkey, c_name AS name, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS segment, 3 AS fields FROM customer")
def json_document(spark, sf):
    """A JSON document per row, read back field by field; NULL fields are kept."""
    rows = table(spark, sf, "customer").select(
        "c_custkey", "c_name", F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("segment")
    )
    doc = rows.select(to_document("c_custkey", "c_name", "segment").alias("doc"))
    return doc.select(
        F.get_json_object("doc", "$.c_custkey").cast("long").alias("c_custkey"),
        F.get_json_object("doc", "$.c_name").alias("name"),
        F.get_json_object("doc", "$.segment").alias("segment"),
        F.size(F.json_object_keys("doc")).alias("fields"),
    )


@entry(
    "json_number",
    """SELECT event_id, CASE WHEN event_type = 'click' THEN 0.0 ELSE CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS k FROM events""",
)
def json_number_query(spark, sf):
    """Clicks carry text instead of a number: ignored."""
    doc = F.when(F.col("event_type") == "click", '{"k": "none"}').otherwise(F.col("props"))
    return table(spark, sf, "events").select("event_id", F.coalesce(json_number(doc, "$.k"), F.lit(0.0)).alias("k"))


@entry(
    "iso_cutoff",
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS started_at FROM events
WHERE event_type <> 'click' AND date_trunc('second', ts) >= TIMESTAMP '2024-01-31' - INTERVAL 72 HOUR""",
)
def iso_cutoff(spark, sf):
    iso = F.when(F.col("event_type") == "click", "yesterday").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    parsed = table(spark, sf, "events").select("event_id", iso_timestamp(iso).alias("t"))
    recent = parsed.filter(F.col("t") >= clock("2024-01-31 00:00:00") - F.make_dt_interval(F.lit(3)))
    return recent.select("event_id", F.date_format("t", "yyyy-MM-dd HH:mm:ss").alias("started_at"))
