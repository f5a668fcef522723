"""Queries: counts, revenue, rankings, enrichment, star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from custodia.catalog.roles import (
    DAILY, LAYOUT, LIFECYCLE, PASSES, SOME_ZONES, TRIPS, TRIPS_AS_OF, VERSIONS, ZONES,
    lifecycle, number, some_zones, table, text, trips, versions, with_ctes, zones,
)
from custodia.functions import duration_minutes
from custodia.operators import enrich, metrics, quality, sketches, star
from custodia.operators.keys import KeyRegistry, extend_keys, surrogate_keys
from custodia.plans.jobs import TripLayout, curated, star_job
from custodia.session import clock, work_dir

ENTRIES = {}


def entry(name, sql=None):
    def add(fn):
        ENTRIES[name] = (fn, sql)
        return fn

    return add


# the workflow's input needs one role of the lookup only
PICKUP_ONLY = TripLayout(roles={"PU_": "pu_zone_id"})


def daily(spark, sf):
    """Gate, aggregate per day and zone, and only then join the zone names to the few results."""
    good = quality.promote(trips(spark, sf), LAYOUT.gate())
    per_day = metrics.daily_zone_metrics(good, "pickup_ts", "pu_zone_id", [], "total_amount", "trip_distance")
    names = zones(spark, sf).select("location_id", "zone", "borough")
    return enrich.enrich(per_day, names, "pu_zone_id", "location_id", "PU_").drop("PU_location_id")


@entry("trip_total", with_ctes(TRIPS, body="SELECT COUNT(*) AS trip_count FROM trips"))
def trip_total(spark, sf):
    return metrics.total_rows(trips(spark, sf)).withColumnRenamed("row_count", "trip_count")


@entry("trips_by_code", with_ctes(TRIPS, body="SELECT payment_type, COUNT(*) AS rows FROM trips GROUP BY 1"))
def trips_by_code(spark, sf):
    return metrics.count_by(trips(spark, sf), "payment_type")


@entry(
    "top_zones_by_trips",
    with_ctes(TRIPS, ZONES, body="""
SELECT location_id, borough, zone, trips, row_number() OVER (ORDER BY trips DESC, location_id) AS position FROM (
  SELECT location_id, borough, zone, COUNT(*) AS trips FROM trips JOIN zones ON pu_zone_id = location_id
  GROUP BY 1, 2, 3 ORDER BY trips DESC, location_id LIMIT 20)"""),
)
def top_zones_by_trips(spark, sf):
    zone = metrics.zone_measures(
        trips(spark, sf), zones(spark, sf), "pu_zone_id", "location_id", "total_amount", ["borough", "zone"]
    )
    best = metrics.top(zone, "trips", 20, "location_id").drop("revenue")
    return metrics.number_rows(best, F.desc("trips"), "location_id")


@entry(
    "top_zones_by_revenue",
    with_ctes(TRIPS, ZONES, body="""
SELECT location_id, borough, zone, CAST(revenue AS DOUBLE) AS revenue,
       row_number() OVER (ORDER BY revenue DESC, location_id) AS position FROM (
  SELECT location_id, borough, zone, SUM(COALESCE(total_amount, 0)) AS revenue
  FROM trips JOIN zones ON pu_zone_id = location_id
  GROUP BY 1, 2, 3 ORDER BY revenue DESC, location_id LIMIT 10)"""),
)
def top_zones_by_revenue(spark, sf):
    zone = metrics.zone_measures(
        trips(spark, sf), zones(spark, sf), "pu_zone_id", "location_id", "total_amount", ["borough", "zone"]
    )
    best = metrics.top(zone, "revenue", 10, "location_id").drop("trips")
    return metrics.number_rows(best, F.desc("revenue"), "location_id").withColumn("revenue", number("revenue"))


ZONE_RANK = with_ctes(TRIPS, ZONES, body="""
SELECT borough, zone, CAST(revenue AS DOUBLE) AS revenue,
       DENSE_RANK() OVER (PARTITION BY borough ORDER BY revenue DESC) AS borough_rank
FROM (SELECT pu_zone_id, SUM(COALESCE(total_amount, 0)) AS revenue FROM trips GROUP BY 1)
JOIN zones ON pu_zone_id = location_id""")


@entry("zone_rank_in_borough", ZONE_RANK)
def zone_rank_in_borough(spark, sf):
    zone = metrics.zone_measures(
        trips(spark, sf), zones(spark, sf), "pu_zone_id", "location_id", "total_amount", ["borough", "zone"]
    )
    ranked = metrics.rank_within(zone, "borough", "revenue", "borough_rank")
    return ranked.select("borough", "zone", number("revenue").alias("revenue"), "borough_rank").orderBy(
        "borough", "borough_rank", F.desc("revenue")
    )


@entry(
    "ranked_listing",
    with_ctes("ranked AS (" + ZONE_RANK.replace("WITH ", "WITH ", 1) + ")", body="""
SELECT *, row_number() OVER (ORDER BY borough, borough_rank, zone) AS position FROM ranked"""),
)
def ranked_listing(spark, sf):
    """One row per zone, so the listing is as small as the dimension."""
    return metrics.number_rows(zone_rank_in_borough(spark, sf), "borough", "borough_rank", "zone")


CURATED_COLUMNS = [
    "order_id", "line_no", "part_id", "vendor_id", "pickup_ts", "dropoff_ts", "trip_distance", "fare_amount",
    "total_amount", "payment_type", "pu_zone_id", "do_zone_id", "PU_borough", "PU_zone", "PU_service_zone",
    "DO_borough", "DO_zone", "DO_service_zone", "year", "month",
]


@entry(
    "curated_trips",
    with_ctes(TRIPS, ZONES, SOME_ZONES, body="""
SELECT order_id, line_no, part_id, vendor_id, CAST(pickup_ts AS VARCHAR) AS pickup_ts,
       CAST(dropoff_ts AS VARCHAR) AS dropoff_ts, trip_distance, fare_amount,
       CAST(total_amount AS DOUBLE) AS total_amount, payment_type, pu_zone_id, do_zone_id,
       p.borough AS "PU_borough", p.zone AS "PU_zone", p.service_zone AS "PU_service_zone",
       d.borough AS "DO_borough", d.zone AS "DO_zone", d.service_zone AS "DO_service_zone",
       year(pickup_ts) AS year, month(pickup_ts) AS month
FROM trips LEFT JOIN some_zones p ON pu_zone_id = p.location_id
LEFT JOIN some_zones d ON do_zone_id = d.location_id WHERE """ + PASSES),
)
def curated_trips(spark, sf):
    out = curated(trips(spark, sf), some_zones(spark, sf), LAYOUT).select(*CURATED_COLUMNS)
    return out.withColumns(
        {"pickup_ts": text("pickup_ts"), "dropoff_ts": text("dropoff_ts"), "total_amount": number("total_amount")}
    )


@entry(
    "trip_duration",
    with_ctes(TRIPS, body="""
SELECT order_id, line_no, part_id, vendor_id,
       ROUND((epoch_us(dropoff_ts) - epoch_us(pickup_ts)) / 6e7, 4) AS minutes FROM trips"""),
)
def trip_duration(spark, sf):
    return trips(spark, sf).select(
        "order_id", "line_no", "part_id", "vendor_id",
        F.round(duration_minutes("pickup_ts", "dropoff_ts"), 4).alias("minutes"),
    )


@entry(
    "enrich_two_roles",
    with_ctes(TRIPS, ZONES, SOME_ZONES, body="""
SELECT order_id, line_no, part_id, pu_zone_id, do_zone_id,
       CAST(p.location_id AS VARCHAR) AS "PU_location_id", p.zone AS "PU_zone",
       CAST(d.location_id AS VARCHAR) AS "DO_location_id", d.zone AS "DO_zone"
FROM trips LEFT JOIN some_zones p ON pu_zone_id = p.location_id
LEFT JOIN some_zones d ON do_zone_id = d.location_id""").replace(
        '"PU_location_id"', '"pickup_zone_id"').replace('"DO_location_id"', '"dropoff_zone_id"'),
)
def enrich_two_roles(spark, sf):
    roles = {"from_": "pu_zone_id", "to_": "do_zone_id"}
    both = enrich.enrich_roles(trips(spark, sf), some_zones(spark, sf), "location_id", roles, salts=4)
    return both.select(
        "order_id", "line_no", "part_id", "pu_zone_id", "do_zone_id",
        text("from_location_id").alias("pickup_zone_id"), F.col("from_zone").alias("PU_zone"),
        text("to_location_id").alias("dropoff_zone_id"), F.col("to_zone").alias("DO_zone"),
    )


@entry(
    "zone_day_metrics",
    with_ctes(TRIPS, ZONES, DAILY, body="""
SELECT CAST(trip_date AS VARCHAR) AS trip_date, pu_zone_id, "PU_zone", "PU_borough", trip_count,
       CAST(total_revenue AS DOUBLE) AS total_revenue, ROUND(avg_distance, 4) AS avg_distance FROM daily"""),
)
def zone_day_metrics(spark, sf):
    return daily(spark, sf).withColumns(
        {"trip_date": text("trip_date"), "total_revenue": number("total_revenue"), "avg_distance": F.round("avg_distance", 4)}
    )


@entry(
    "revenue_borough_month",
    with_ctes(TRIPS, ZONES, DAILY, body="""
SELECT CAST(CAST(date_trunc('month', trip_date) AS DATE) AS VARCHAR) AS month, "PU_borough",
       CAST(SUM(total_revenue) AS DOUBLE) AS revenue FROM daily GROUP BY 1, 2"""),
)
def revenue_borough_month(spark, sf):
    return metrics.monthly_rollup(daily(spark, sf), "PU_borough").select(
        text("month").alias("month"), "PU_borough", number("revenue").alias("revenue")
    )


@entry(
    "star_borough_revenue",
    with_ctes(TRIPS, ZONES, body="""
SELECT borough, CAST(SUM(total_amount) AS DOUBLE) AS revenue, COUNT(*) AS trips
FROM trips JOIN zones ON pu_zone_id = location_id GROUP BY 1"""),
)
def star_borough_revenue(spark, sf):
    """Borough totals over the star; the fact is summed per surrogate key before the dimension join."""
    dim = star.keyed(zones(spark, sf), "location_id", "zone_sk")
    fact = star.resolve_keys(trips(spark, sf), {"pu_zone_sk": (dim, "location_id", "zone_sk", "pu_zone_id")})
    per_key = fact.groupBy("pu_zone_sk").agg(F.sum("total_amount").alias("revenue"), F.count("*").alias("trips"))
    joined = per_key.join(dim, F.col("pu_zone_sk") == F.col("zone_sk"))
    return joined.groupBy("borough").agg(
        number(F.sum("revenue")).alias("revenue"), F.sum("trips").alias("trips")
    )


@entry(
    "fact_dim_inner",
    with_ctes(TRIPS, ZONES, SOME_ZONES, body="""
SELECT order_id, line_no, part_id, zone, CAST(total_amount AS DOUBLE) AS total_amount
FROM trips JOIN some_zones ON pu_zone_id = location_id"""),
)
def fact_dim_inner(spark, sf):
    fact, dim = trips(spark, sf), some_zones(spark, sf)
    return fact.join(dim, fact.pu_zone_id == dim.location_id).select(
        "order_id", "line_no", "part_id", "zone", number("total_amount").alias("total_amount")
    )


@entry(
    "preaggregate_join",
    with_ctes(TRIPS, ZONES, SOME_ZONES, body="""
SELECT location_id, zone, trips, CAST(revenue AS DOUBLE) AS revenue FROM (
  SELECT do_zone_id, COUNT(*) AS trips, SUM(COALESCE(total_amount, 0)) AS revenue FROM trips GROUP BY 1)
JOIN some_zones ON do_zone_id = location_id"""),
)
def preaggregate_join(spark, sf):
    out = metrics.zone_measures(
        trips(spark, sf), some_zones(spark, sf), "do_zone_id", "location_id", "total_amount", ["zone"]
    )
    return out.withColumn("revenue", number("revenue"))


# -- profile ------------------------------------------------------------------------


@entry(
    "column_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) AS rows, COUNT(*) - COUNT({c}) AS nulls, "
        f"CAST(MIN({c}) AS VARCHAR) AS min_value, CAST(MAX({c}) AS VARCHAR) AS max_value FROM lineitem"
        for c in ("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate")
    ),
)
def column_profile(spark, sf):
    return metrics.profile(
        table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate"]
    )


@entry(
    "merged_profile",
    """
SELECT strftime(l_shipdate, '%Y') AS year, 'l_partkey' AS column_name, COUNT(*) AS rows, 0 AS nulls, COUNT(DISTINCT l_partkey) AS exact_distinct, TRUE AS distinct_ok, TRUE AS median_ok FROM lineitem GROUP BY 1
UNION ALL SELECT strftime(l_shipdate, '%Y'), 'l_extendedprice', COUNT(*), 0, COUNT(DISTINCT l_extendedprice), TRUE, TRUE FROM lineitem GROUP BY 1
UNION ALL SELECT 'all', 'l_partkey', COUNT(*), 0, COUNT(DISTINCT l_partkey), TRUE, TRUE FROM lineitem
UNION ALL SELECT 'all', 'l_extendedprice', COUNT(*), 0, COUNT(DISTINCT l_extendedprice), TRUE, TRUE FROM lineitem""",
)
def merged_profile(spark, sf):
    """Sketches stored per month, merged per year and for the table, next to exact values: whether each is within its stated error."""
    columns = ["l_partkey", "l_extendedprice"]
    # rows carry whole numbers; years and months become text once a part
    lines = table(spark, sf, "lineitem").select(*columns, F.year("l_shipdate").alias("y"), F.month("l_shipdate").alias("m"))
    first_day = F.make_date("y", "m", F.lit(1))
    path = work_dir(spark, "profiles")
    parts = sketches.profile_parts(lines, columns, ["y", "m"])
    parts.withColumns({"year": F.date_format(first_day, "yyyy"), "month": F.date_format(first_day, "yyyy-MM")}).write.parquet(path)
    parts = spark.read.parquet(path)
    merged = sketches.merge_profiles(parts, ["year", "y"]).unionByName(sketches.merge_profiles(parts).withColumns({"year": F.lit("all"), "y": F.lit(None).cast("int")}))
    found = sketches.read_profiles(merged)
    # each value of a year once, with its rows; the table's values from those of the years
    values = lines.select("y", F.inline(F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("v")) for i, c in enumerate(columns)])))
    counted = values.groupBy("y", "c", "v").agg(F.count("*").alias("n"))
    of_all = counted.groupBy("c", "v").agg(F.sum("n").alias("n")).select(F.lit(None).cast("int").alias("y"), "c", "v", "n", F.lit(True).alias("whole"))
    counted = counted.select("y", "c", "v", "n", F.lit(False).alias("whole")).unionAll(of_all)
    # one row per year and column
    middle = F.broadcast(found.select(
        F.col("y").alias("of"), (F.col("year") == "all").alias("of_whole"), (F.array_position(F.array(*map(F.lit, columns)), F.col("column_name")) - 1).alias("of_c"),
        "q50", "year", F.col("column_name").alias("column"),
    ))
    counted = counted.join(middle, F.col("y").eqNullSafe(F.col("of")) & (F.col("whole") == F.col("of_whole")) & (F.col("c") == F.col("of_c")))
    below, up_to, known = (F.sum(F.when(x, F.col("n"))) for x in (F.col("v") < F.col("q50"), F.col("v") <= F.col("q50"), F.col("v").isNotNull()))
    exact = counted.groupBy(F.col("year").alias("y"), F.col("column").alias("c")).agg(
        F.count("v").alias("exact"), (F.coalesce(below, F.lit(0)) / known).alias("below"), (F.coalesce(up_to, F.lit(0)) / known).alias("up_to")
    )
    found = found.drop("y")
    both = found.join(exact, (F.col("year") == F.col("y")) & (F.col("column_name") == F.col("c")))
    off = F.abs(F.col("distinct_values") - F.col("exact"))
    return both.select(
        "year", "column_name", "rows", F.col("nulls").cast("int").alias("nulls"), F.col("exact").alias("exact_distinct"),
        (off <= F.greatest(F.lit(sketches.DISTINCT_ERROR) * F.col("exact"), F.lit(1))).alias("distinct_ok"),
        ((F.col("below") <= 0.5 + sketches.RANK_ERROR) & (F.col("up_to") >= 0.5 - sketches.RANK_ERROR)).alias("median_ok"),
    )


@entry(
    "value_distribution",
    with_ctes(VERSIONS, body="SELECT COALESCE(segment, 'UNKNOWN') AS value, COUNT(*) AS rows FROM versions GROUP BY 1"),
)
def value_distribution(spark, sf):
    return metrics.value_distribution(versions(spark, sf), "segment")


@entry(
    "uniqueness",
    with_ctes(VERSIONS, body="""
SELECT COUNT(*) AS rows, COUNT(DISTINCT segment) AS distinct_keys,
       COUNT(DISTINCT segment) + MAX(CASE WHEN segment IS NULL THEN 1 ELSE 0 END) AS distinct_with_null FROM versions"""),
)
def uniqueness(spark, sf):
    return metrics.uniqueness(versions(spark, sf), "segment")


# -- star ---------------------------------------------------------------------------


@entry(
    "star_fact",
    with_ctes(TRIPS, ZONES, SOME_ZONES, LIFECYCLE, body="""
SELECT order_id, line_no, part_id, CAST(CAST(pickup_ts AS DATE) AS VARCHAR) AS full_date,
       CAST(l.vendor_id AS VARCHAR) AS dim_vendor_id, CAST(p.location_id AS VARCHAR) AS pu_dim_id,
       CAST(d.location_id AS VARCHAR) AS do_dim_id
FROM trips t LEFT JOIN lifecycle l ON t.vendor_id = l.vendor_id AND l.lifecycle_state = 'ACTIVE'
LEFT JOIN some_zones p ON pu_zone_id = p.location_id
LEFT JOIN some_zones d ON do_zone_id = d.location_id"""),
)
def star_fact(spark, sf):
    """The fact with its surrogate keys, resolved back to natural keys: proves each key leads home."""
    vendors = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("vendor_id"), "s_name")
    built = star_job(trips(spark, sf), some_zones(spark, sf), vendors, lifecycle(spark, sf), LAYOUT, work_dir(spark, "star"))
    back = star.resolve_keys(
        built["fact"],
        {
            "dim_date_back": (built["dim_date"], "date_sk", "full_date", "date_sk"),
            "dim_vendor_back": (built["dim_vendor"], "vendor_sk", "vendor_id", "vendor_sk"),
            "pu_back": (built["dim_zone"], "zone_sk", "location_id", "pu_zone_sk"),
            "do_back": (built["dim_zone"], "zone_sk", "location_id", "do_zone_sk"),
        },
    )
    return back.select(
        "order_id", "line_no", "part_id", text("dim_date_back").alias("full_date"),
        text("dim_vendor_back").alias("dim_vendor_id"), text("pu_back").alias("pu_dim_id"),
        text("do_back").alias("do_dim_id"),
    )


@entry(
    "date_dim",
    """SELECT DISTINCT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS full_date, year(o_orderdate) AS year,
       month(o_orderdate) AS month, day(o_orderdate) AS day, dayofweek(o_orderdate) AS day_of_week FROM orders""",
)
def date_dim(spark, sf):
    return star.date_dimension(table(spark, sf, "orders"), "o_orderdate").withColumn("full_date", text("full_date"))


@entry(
    "dim_zone_approved",
    with_ctes(VERSIONS, body="""
SELECT customer_id, name, segment, version_number, CAST(effective_from AS VARCHAR) AS effective_from, approved_by
FROM versions WHERE is_current AND approval_status = 'APPROVED'"""),
)
def dim_zone_approved(spark, sf):
    columns = ["customer_id", "name", "segment", "version_number", "effective_from", "approved_by"]
    return star.approved_dimension(versions(spark, sf), columns).withColumn("effective_from", text("effective_from"))


@entry(
    "orphan_rate",
    with_ctes(TRIPS, ZONES, SOME_ZONES, body="""
SELECT ROUND(100.0 * SUM(CASE WHEN p.location_id IS NULL THEN 1 ELSE 0 END) / NULLIF(COUNT(*), 0), 4) AS orphan_pu_pct,
       ROUND(100.0 * SUM(CASE WHEN d.location_id IS NULL THEN 1 ELSE 0 END) / NULLIF(COUNT(*), 0), 4) AS orphan_do_pct
FROM trips LEFT JOIN some_zones p ON pu_zone_id = p.location_id
LEFT JOIN some_zones d ON do_zone_id = d.location_id
WHERE pickup_ts >= TIMESTAMP '2001-08-01' - INTERVAL 7 DAY"""),
)
def orphan_rate(spark, sf):
    dim = star.keyed(some_zones(spark, sf), "location_id", "zone_sk")
    recent = F.col("pickup_ts") >= clock(TRIPS_AS_OF) - F.make_dt_interval(F.lit(7))
    fact = star.resolve_keys(
        trips(spark, sf).filter(recent),
        {
            "pu_zone_sk": (dim, "location_id", "zone_sk", "pu_zone_id"),
            "do_zone_sk": (dim, "location_id", "zone_sk", "do_zone_id"),
        },
    )
    shares = metrics.null_share(fact, {"orphan_pu_pct": "pu_zone_sk", "orphan_do_pct": "do_zone_sk"})
    return shares.select(*[F.round(c, 4).alias(c) for c in shares.columns])


@entry(
    "star_expectations",
    with_ctes(TRIPS, ZONES, SOME_ZONES, body="""
SELECT 'pu_orphans' AS expectation, ROUND(v, 4) AS value, CASE WHEN v <= 0.1 THEN 'PASS' ELSE 'FAIL' END AS status FROM (
  SELECT 100.0 * COUNT(*) FILTER (WHERE location_id IS NULL) / COUNT(*) AS v
  FROM trips LEFT JOIN some_zones ON pu_zone_id = location_id)
UNION ALL
SELECT 'negative_amount_rows', CAST(n AS DOUBLE), CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END
FROM (SELECT COUNT(*) FILTER (WHERE total_amount < 0) AS n FROM trips)"""),
)
def star_expectations(spark, sf):
    dim = star.keyed(some_zones(spark, sf), "location_id", "zone_sk")
    fact = star.resolve_keys(trips(spark, sf), {"pu_zone_sk": (dim, "location_id", "zone_sk", "pu_zone_id")})
    return star.star_expectations(fact, {"pu_orphans": "pu_zone_sk"}, "total_amount", 0.1).withColumn(
        "value", F.round("value", 4)
    )


def registry(spark, sf):
    """One governed dataset per nation; NATION_0 stands for the fact."""
    return table(spark, sf, "nation").select(
        F.lower("n_name").alias("dataset_name"), F.concat(F.lit("team "), F.col("n_regionkey").cast("string")).alias("owner_team")
    )


@entry(
    "dashboard_kpis",
    with_ctes(TRIPS, body="""
SELECT lower(n_name) AS dataset_name, 'team ' || CAST(n_regionkey AS VARCHAR) AS owner_team,
       CAST(SUM(total_amount) AS DOUBLE) AS revenue_30d, COUNT(*) AS trips_30d
FROM nation LEFT JOIN trips ON lower(n_name) = 'nation_0' AND pickup_ts >= TIMESTAMP '2001-08-01' - INTERVAL 30 DAY
GROUP BY 1, 2"""),
)
def dashboard_kpis(spark, sf):
    kpis = star.dataset_kpis(
        registry(spark, sf), trips(spark, sf), "nation_0", "pickup_ts", "total_amount", TRIPS_AS_OF,
        count_missing_as_one=True,
    )
    return kpis.select("dataset_name", "owner_team", number("revenue_30d").alias("revenue_30d"), "trips_30d")


@entry(
    "dataset_range_join",
    with_ctes(TRIPS, body="""
SELECT lower(n_name) AS dataset_name, CAST(SUM(total_amount) AS DOUBLE) AS revenue_30d, COUNT(order_id) AS trips_30d
FROM nation LEFT JOIN trips ON lower(n_name) = 'nation_0' AND pickup_ts >= TIMESTAMP '2001-08-01' - INTERVAL 30 DAY
GROUP BY 1"""),
)
def dataset_range_join(spark, sf):
    kpis = star.dataset_kpis(
        registry(spark, sf), trips(spark, sf), "nation_0", "pickup_ts", "total_amount", TRIPS_AS_OF
    )
    return kpis.select("dataset_name", number("revenue_30d").alias("revenue_30d"), "trips_30d")


@entry(
    "surrogate_keys",
    """SELECT COUNT(*) AS rows, COUNT(*) AS distinct_keys, TRUE AS above_start,
       COUNT(DISTINCT c_nationkey) AS nations FROM customer""",
)
def surrogate_keys_check(spark, sf):
    """Keys of all customers after 100 existing ones: unique and new."""
    keyed = surrogate_keys(table(spark, sf, "customer"), ["c_custkey"], "customer_sk", start=100)
    return keyed.agg(
        F.count("*").alias("rows"),
        F.count_distinct("customer_sk").alias("distinct_keys"),
        (F.min("customer_sk") > 100).alias("above_start"),
        F.count_distinct("c_nationkey").alias("nations"),
    )


@entry(
    "surrogate_keys_extended",
    """SELECT c_custkey, TRUE AS key_kept, TRUE AS key_new FROM customer""",
)
def surrogate_keys_extended(spark, sf):
    """Keys of two thirds of the customers, then of all: whether old members keep theirs and new ones get others."""
    customers = table(spark, sf, "customer").select("c_custkey")
    path = work_dir(spark, "keys")
    surrogate_keys(customers.filter("c_custkey % 3 <> 0"), ["c_custkey"], "customer_sk").write.parquet(path)
    old = spark.read.parquet(path)
    before = old.select("c_custkey", F.col("customer_sk").alias("old_sk"))
    keyed = extend_keys(customers, ["c_custkey"], "customer_sk", old).join(before, "c_custkey", "left")
    used = before.select(F.col("old_sk").alias("customer_sk"), F.lit(True).alias("used"))
    keyed = keyed.join(used, "customer_sk", "left")
    return keyed.select(
        "c_custkey",
        F.coalesce(F.col("customer_sk") == F.col("old_sk"), F.lit(True)).alias("key_kept"),
        (F.col("old_sk").isNotNull() | F.col("used").isNull()).alias("key_new"),
    )


@entry(
    "key_registry",
    """
SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN 1 WHEN c_custkey % 2 = 0 THEN 2 ELSE 3 END AS first_build,
       CASE WHEN c_custkey % 3 <> 0 AND c_custkey % 2 <> 0 THEN 3 WHEN c_custkey % 3 <> 0 THEN 1 WHEN c_custkey % 2 = 0 THEN 2 ELSE 3 END AS last_build, TRUE AS present,
       1 AS keys, 1 AS owners, TRUE AS above_earlier FROM customer""",
)
def key_registry(spark, sf):
    """Three builds: two thirds of the customers, the even ones, all. Whether every member kept one key and every key one member."""
    customers = table(spark, sf, "customer").select("c_custkey")
    registry = KeyRegistry(spark, work_dir(spark, "registry"), {"c_custkey": "long"}, "customer_sk")
    given = None
    for build, chosen in enumerate(("c_custkey % 3 <> 0", "c_custkey % 2 = 0", "true"), 1):
        path = work_dir(spark, "build")
        registry.register(customers.filter(chosen), build).withColumn("build", F.lit(build)).write.parquet(path)
        one = spark.read.parquet(path)
        given = one if given is None else given.unionByName(one)
    keys = given.groupBy("c_custkey").agg(F.count_distinct("customer_sk").alias("keys"), F.min("build").alias("since"))
    owners = given.groupBy("customer_sk").agg(F.count_distinct("c_custkey").alias("owners"))
    members = registry.members().join(keys, "c_custkey").join(owners, "customer_sk")
    # keys of later builds lie above all keys of earlier ones: the highest key of each build, three rows
    highest = members.groupBy((F.col("first_build") + 1).alias("b")).agg(F.max("customer_sk").alias("below"))
    below = members.join(highest, F.col("first_build") == F.col("b"), "left")
    return below.select(
        "c_custkey", "first_build", "last_build", "present", F.col("keys").cast("int").alias("keys"), F.col("owners").cast("int").alias("owners"),
        (F.col("customer_sk") > F.coalesce("below", F.lit(0))).alias("above_earlier"),
    )


@entry(
    "master_lifecycle_join",
    with_ctes(LIFECYCLE, body="""
SELECT s_suppkey AS vendor_id, s_name AS vendor_name, lifecycle_state
FROM supplier LEFT JOIN lifecycle ON s_suppkey = vendor_id"""),
)
def master_lifecycle_join(spark, sf):
    from custodia.operators.lifecycle import with_state

    master = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("vendor_id"), F.col("s_name").alias("vendor_name"))
    return with_state(master, lifecycle(spark, sf), "vendor_id")
