"""Queries: views, dictionary, manifests, registries, tags, retention."""

from __future__ import annotations

from pyspark.sql import functions as F

from custodia.catalog.roles import AS_OF, TRIPS, table, text, trips, with_ctes
from custodia.functions import mask_email
from custodia.operators import align, governance, upsert
from custodia.sources import expired_partitions

ENTRIES = {}


def entry(name, sql=None):
    def add(fn):
        ENTRIES[name] = (fn, sql)
        return fn

    return add


@entry(
    "masked_view",
    """SELECT c_custkey, c_nationkey, CASE WHEN c_acctbal < 0 THEN NULL
       ELSE substr(lower(c_mktsegment), 1, 1) || '***@example.com' END AS email_masked FROM customer""",
)
def masked_view(spark, sf):
    """Debtors have no address; the raw address is not in the view."""
    email = F.when(
        F.col("c_acctbal") >= 0, F.concat(F.lower("c_mktsegment"), F.col("c_custkey").cast("string"), F.lit("@example.com"))
    )
    people = table(spark, sf, "customer").withColumn("email", email)
    return align.project_view(people, ["c_custkey", "c_nationkey"], {"email_masked": mask_email("email")})


CERTIFIED = ["order_id", "line_no", "vendor_id", "pickup_ts", "dropoff_ts", "trip_distance", "fare_amount", "payment_type"]


@entry(
    "certified_view",
    with_ctes(TRIPS, body="""
SELECT order_id, line_no, vendor_id, CAST(pickup_ts AS VARCHAR) AS pickup_ts, CAST(dropoff_ts AS VARCHAR) AS dropoff_ts,
       trip_distance, fare_amount, payment_type FROM trips"""),
)
def certified_view(spark, sf):
    align.project_view(trips(spark, sf), CERTIFIED).createOrReplaceTempView("certified_trips")
    view = spark.table("certified_trips")
    return view.withColumns({"pickup_ts": text("pickup_ts"), "dropoff_ts": text("dropoff_ts")})


DICTIONARY_TABLES = ("customer", "lineitem", "orders", "supplier")
MEANINGS = {
    "l_shipdate": ("Date the line was shipped", "NOT NULL"),
    "o_orderdate": ("Date of the order", "NOT NULL"),
    "c_custkey": ("Customer identifier", "Unique"),
}


@entry(
    "data_dictionary",
    "WITH counted AS (" + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS rows FROM {t}" for t in DICTIONARY_TABLES
    ) + """)
SELECT DISTINCT table_name, column_name, CAST(ordinal_position AS INTEGER) AS position,
       CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string'
            WHEN 'DOUBLE' THEN 'double' ELSE 'timestamp_ntz' END AS data_type,
       CASE column_name WHEN 'l_shipdate' THEN 'Date the line was shipped' WHEN 'o_orderdate' THEN 'Date of the order'
            WHEN 'c_custkey' THEN 'Customer identifier' ELSE 'TODO: Add business meaning' END AS meaning,
       'Internal' AS sensitivity, 'DataEngineering' AS owner, 'DataEngineering' AS steward, '730 days' AS retention,
       CASE WHEN column_name IN ('l_shipdate', 'o_orderdate') THEN 'NOT NULL' WHEN column_name = 'c_custkey' THEN 'Unique'
            ELSE 'TODO: Add quality rule' END AS quality_rule, rows
FROM information_schema.columns JOIN counted USING (table_name)""",
)
def data_dictionary(spark, sf):
    """Columns of the tables with meaning, governance and measured row count."""
    tables = {t: table(spark, sf, t) for t in DICTIONARY_TABLES}
    known = spark.createDataFrame(
        [(c, m, r) for c, (m, r) in MEANINGS.items()], "column_name string, meaning string, quality_rule string"
    )
    counted = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("rows")).withColumn("table_name", F.lit(name))
        counted = one if counted is None else counted.unionByName(one)
    dictionary = governance.data_dictionary(governance.schema_rows(spark, tables), known)
    return dictionary.join(counted, "table_name")


def manifests(spark, sf):
    """One manifest per part: brands give owners, small parts lack a layer, and so on."""
    part = table(spark, sf, "part")
    size = F.col("p_size")
    asset = F.struct(
        F.when(size < 40, F.col("p_name")).alias("name"),
        F.when(size < 20, "master").when(size < 30, "reference").otherwise("snapshot").alias("type"),
        F.when(size < 25, "parquet").otherwise("orc").alias("format"),
    )
    return part.select(
        F.col("p_partkey").cast("string").alias("manifest"),
        F.col("p_name").alias("dataset"),
        F.lit("parts").alias("domain"),
        F.when(size < 10, F.lit(None)).when(size < 30, "gold").otherwise("platinum").alias("layer"),
        F.when(F.col("p_retailprice") > 950, F.col("p_brand")).alias("owner"),
        F.when(size > 15, "Internal").otherwise("Secret").alias("classification"),
        F.struct(F.when(size > 35, "-1").when(size > 30, "soon").otherwise("30").alias("raw_days")).alias("retention_policy"),
        F.when(size > 5, F.array(asset)).otherwise(F.array().cast("array<struct<name:string,type:string,format:string>>")).alias("data_assets"),
    )


@entry(
    "manifest_violations",
    """SELECT CAST(p_partkey AS VARCHAR) AS manifest, field, problem FROM part, LATERAL (
  SELECT 'layer' AS field, 'missing' AS problem WHERE p_size < 10
  UNION ALL SELECT 'owner', 'missing' WHERE p_retailprice <= 950
  UNION ALL SELECT 'data_assets', 'missing' WHERE p_size <= 5
  UNION ALL SELECT 'layer', 'not_allowed' WHERE p_size >= 30
  UNION ALL SELECT 'classification', 'not_allowed' WHERE p_size <= 15
  UNION ALL SELECT 'retention_policy.raw_days', 'not_allowed' WHERE p_size > 30
  UNION ALL SELECT 'data_assets.name', 'missing' WHERE p_size >= 40
  UNION ALL SELECT 'data_assets.type', 'not_allowed' WHERE p_size >= 30
  UNION ALL SELECT 'data_assets.format', 'not_allowed' WHERE p_size >= 25) AS v""",
)
def manifest_violations(spark, sf):
    return governance.manifest_violations(manifests(spark, sf))


def registry(spark, sf):
    """Registered transforms: one per part type."""
    return table(spark, sf, "part").groupBy(F.col("p_type").alias("transform_name")).agg(
        F.lit("team").alias("owner"), F.lit(1).alias("version"),
        F.max(F.lit("2024-01-01 00:00:00")).cast("timestamp_ntz").alias("updated_at"),
        F.lit("system").alias("updated_by"),
    )


@entry(
    "registry_upsert",
    """SELECT DISTINCT p_type AS transform_name, CASE WHEN p_type < 'M' THEN 'new team' ELSE 'team' END AS owner,
       CASE WHEN p_type < 'M' THEN 2 ELSE 1 END AS version,
       CASE WHEN p_type < 'M' THEN 'data_engineer' ELSE 'system' END AS updated_by FROM part""",
)
def registry_upsert(spark, sf):
    known = registry(spark, sf)
    incoming = known.filter("transform_name < 'M'").select("transform_name", F.lit("new team").alias("owner"))
    return upsert.upsert_type1(known, incoming, ["transform_name"], ["owner"], AS_OF).drop("updated_at")


@entry(
    "registry_replace",
    """SELECT lower(n_name) AS dataset_name, 'Operations Team' AS owner_team, 0.99 AS completeness_pct FROM nation WHERE n_regionkey = 1
UNION ALL SELECT lower(n_name), 'team ' || n_regionkey, 0.5 FROM nation WHERE n_regionkey <> 1""",
)
def registry_replace(spark, sf):
    nation = table(spark, sf, "nation")
    known = nation.select(
        F.lower("n_name").alias("dataset_name"), F.concat(F.lit("team "), F.col("n_regionkey").cast("string")).alias("owner_team"),
        F.lit(0.5).alias("completeness_pct"),
    )
    rows = nation.filter("n_regionkey = 1").select(
        F.lower("n_name").alias("dataset_name"), F.lit("Operations Team").alias("owner_team"), F.lit(0.99).alias("completeness_pct")
    )
    return upsert.replace_by_key(known, rows, ["dataset_name"])


@entry(
    "retention_partitions",
    """WITH p AS (
  SELECT CASE WHEN year(o_orderdate) < 2001 THEN 'raw/' ELSE 'curated/' END || strftime(o_orderdate, '%Y/%m') AS path,
         MAX(o_orderdate) AS modified_at, COUNT(*) AS files FROM orders GROUP BY 1)
SELECT path, files, CAST(date_diff('day', modified_at, TIMESTAMP '2001-01-20') AS BIGINT) AS age_days FROM p
WHERE path LIKE 'raw/%' AND date_diff('day', modified_at, TIMESTAMP '2001-01-20') >= 30""",
)
def retention_partitions(spark, sf):
    top = F.when(F.year("o_orderdate") < 2001, "raw/").otherwise("curated/")
    inventory = table(spark, sf, "orders").groupBy(
        F.concat(top, F.date_format("o_orderdate", "yyyy/MM")).alias("path")
    ).agg(F.max("o_orderdate").alias("modified_at"), F.count("*").alias("files"))
    return expired_partitions(inventory, "2001-01-20 00:00:00", 30).select("path", "files", "age_days")


@entry(
    "table_tags",
    """SELECT table_name, tag, value FROM (
  SELECT DISTINCT CASE WHEN p_size > 25 THEN 'curated_' ELSE 'raw_' END || lower(p_type) AS table_name FROM part),
 (VALUES ('data_owner', 'DataEngineering'), ('classification', 'Internal')) v(tag, value)
WHERE table_name LIKE 'curated\\_%' ESCAPE '\\'""",
)
def table_tags(spark, sf):
    prefix = F.when(F.col("p_size") > 25, "curated_").otherwise("raw_")
    tables = table(spark, sf, "part").select(F.concat(prefix, F.lower("p_type")).alias("table_name")).distinct()
    return governance.table_tags(tables, "curated_", {"data_owner": "DataEngineering", "classification": "Internal"})
