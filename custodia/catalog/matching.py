"""Queries: duplicates, similarity pairs, merges, golden records, lifecycle, approvals."""

from __future__ import annotations

from pyspark.sql import functions as F

from custodia.catalog.roles import (
    AS_OF, LIFECYCLE, TRIPS, lifecycle, table, text, trips, with_ctes,
)
from custodia.functions import code_label, normalize_party, normalize_place, score_band
from custodia.operators import lifecycle as states
from custodia.operators import matching, merging, metrics, survivorship, upsert
from custodia.operators.survivorship import FieldRule
from custodia.session import ts, work_dir

ENTRIES = {}


def entry(name, sql=None):
    def add(fn):
        ENTRIES[name] = (fn, sql)
        return fn

    return add


# -- names --------------------------------------------------------------------------


def product_names(spark, sf, block=()):
    """Distinct 'name type' texts of all parts, with the smallest part key."""
    named = table(spark, sf, "part").withColumn("product", F.concat_ws(" ", "p_name", F.lower("p_type")))
    return matching.distinct_names(named, "p_partkey", normalize_party("product"), block)


def part_names(spark, sf):
    return matching.distinct_names(table(spark, sf, "part"), "p_partkey", normalize_party("p_name"))


PRODUCTS = """
products AS (
  SELECT lower(p_name || ' ' || p_type) AS name, MIN(p_partkey) AS id, COUNT(*) AS members FROM part GROUP BY 1)
"""
NAMES = "names AS (SELECT p_name AS name, MIN(p_partkey) AS id, COUNT(*) AS members FROM part GROUP BY 1)"

# Longest common subsequence of all name pairs: one dynamic-programming row per character of the left name.
LCS = """
pairs AS (SELECT a.name AS an, b.name AS bn, a.id AS aid, b.id AS bid FROM names a JOIN names b ON a.name < b.name),
dp AS (
  SELECT an, bn, 0 AS i, list_transform(range(0, length(bn) + 1), lambda x: 0) AS line FROM pairs
  UNION ALL
  SELECT an, bn, i + 1,
         list_reduce(list_transform(range(1, length(bn) + 1), lambda j: [CAST(j AS INTEGER)]),
           lambda acc, x: list_append(acc, CASE WHEN substr(an, i + 1, 1) = substr(bn, x[1], 1) THEN line[x[1]] + 1
                                           ELSE greatest(line[x[1] + 1], acc[len(acc)]) END), [0])
  FROM dp WHERE i < length(an)),
lcs AS (SELECT an, bn, line[len(line)] AS n FROM dp WHERE i = length(an)),
rated AS (
  SELECT least(aid, bid) AS left_id, greatest(aid, bid) AS right_id, p.an, p.bn,
         2.0 * n / (length(p.an) + length(p.bn)) AS ratio, jaro_winkler_similarity(p.an, p.bn) AS jw
  FROM pairs p JOIN lcs ON p.an = lcs.an AND p.bn = lcs.bn)
"""


def recursive(sql):
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


def scored(pairs):
    return pairs.select("left_id", "right_id", F.round("score", 6).alias("score"))


@entry(
    "exact_duplicates",
    """SELECT p_partkey, p_name, p_brand, COUNT(*) OVER (PARTITION BY p_brand, p_name) AS group_size FROM part
QUALIFY COUNT(*) OVER (PARTITION BY p_brand, p_name) > 1""",
)
def exact_duplicates(spark, sf):
    part = table(spark, sf, "part")
    found = matching.duplicate_members(part, "p_partkey", [normalize_place("p_brand"), normalize_place("p_name")])
    return found.select("p_partkey", "p_name", "p_brand", "group_size")


@entry(
    "duplicate_groups",
    """SELECT lower(replace(p_brand, '#', '')) || '|' || p_name || '|' || lower(p_type) AS composite, COUNT(*) AS group_size,
       MIN(p_partkey) AS first_id, MAX(p_partkey) AS last_id FROM part GROUP BY 1 HAVING COUNT(*) > 1""",
)
def duplicate_groups(spark, sf):
    parts = [normalize_place(c) for c in ("p_brand", "p_name", "p_type")]
    return matching.duplicate_groups(table(spark, sf, "part"), "p_partkey", parts)


@entry(
    "duplicate_members",
    """SELECT c_custkey, c_nationkey, c_mktsegment,
       MIN(c_custkey) OVER (PARTITION BY c_nationkey, c_mktsegment) AS first_id FROM customer
QUALIFY COUNT(*) OVER (PARTITION BY c_nationkey, c_mktsegment) > 1""",
)
def duplicate_members(spark, sf):
    customer = table(spark, sf, "customer")
    found = matching.duplicate_members(customer, "c_custkey", [F.col("c_nationkey"), normalize_place("c_mktsegment")])
    return found.select("c_custkey", "c_nationkey", "c_mktsegment", "first_id")


@entry(
    "same_name_pairs",
    """SELECT first_id, p_partkey AS other_id FROM part
JOIN (SELECT p_name AS n, MIN(p_partkey) AS first_id FROM part GROUP BY 1) ON p_name = n WHERE p_partkey <> first_id""",
)
def same_name_pairs(spark, sf):
    return matching.same_name_pairs(table(spark, sf, "part"), "p_partkey", normalize_party("p_name")).drop("name")


@entry(
    "pairs_jaro_winkler",
    with_ctes(PRODUCTS, body="""
SELECT least(a.id, b.id) AS left_id, greatest(a.id, b.id) AS right_id,
       ROUND(jaro_winkler_similarity(a.name, b.name), 6) AS score
FROM products a JOIN products b ON a.name < b.name WHERE jaro_winkler_similarity(a.name, b.name) >= 0.9"""),
)
def pairs_jaro_winkler(spark, sf):
    return scored(matching.similar_pairs(product_names(spark, sf), "jaro_winkler", 0.9))


EDIT_SQL = "1.0 - levenshtein(a.name, b.name) / CAST(greatest(length(a.name), length(b.name)) AS DOUBLE)"


@entry(
    "pairs_levenshtein",
    with_ctes(PRODUCTS, body=f"""
SELECT least(a.id, b.id) AS left_id, greatest(a.id, b.id) AS right_id, ROUND({EDIT_SQL}, 6) AS score
FROM products a JOIN products b ON a.name < b.name WHERE {EDIT_SQL} >= 0.8"""),
)
def pairs_levenshtein(spark, sf):
    return scored(matching.similar_pairs(product_names(spark, sf), "edit", 0.8))


@entry(
    "blocked_pairs",
    with_ctes("""products AS (SELECT p_brand, lower(p_name || ' ' || p_type) AS name, MIN(p_partkey) AS id
  FROM part GROUP BY 1, 2)""", body=f"""
SELECT a.p_brand, least(a.id, b.id) AS left_id, greatest(a.id, b.id) AS right_id, ROUND({EDIT_SQL}, 6) AS score
FROM products a JOIN products b ON a.p_brand = b.p_brand AND a.name < b.name WHERE {EDIT_SQL} >= 0.75"""),
)
def blocked_pairs(spark, sf):
    pairs = matching.similar_pairs(product_names(spark, sf, ["p_brand"]), "edit", 0.75, ["p_brand"])
    return pairs.select("p_brand", "left_id", "right_id", F.round("score", 6).alias("score"))


@entry(
    "all_pairs",
    recursive(with_ctes(NAMES, LCS, body="""
SELECT left_id, right_id, ROUND(ratio, 6) AS score FROM rated WHERE ratio >= 0.7""")),
)
def all_pairs(spark, sf):
    """Unblocked pairs by common-subsequence ratio."""
    return scored(matching.similar_pairs(part_names(spark, sf), "indel", 0.7))


@entry(
    "comparison_counts",
    """SELECT p_brand, COUNT(DISTINCT lower(p_name || ' ' || p_type)) AS names,
       COUNT(DISTINCT lower(p_name || ' ' || p_type)) * (COUNT(DISTINCT lower(p_name || ' ' || p_type)) - 1) // 2 AS comparisons
FROM part GROUP BY 1""",
)
def comparison_counts(spark, sf):
    return matching.comparison_counts(product_names(spark, sf, ["p_brand"]), ["p_brand"])


@entry("fuzzy_duplicates")
def fuzzy_duplicates(spark, sf):
    """Matching-blocks ratio within a brand; checked against brute force in the tests."""
    pairs = matching.similar_pairs(product_names(spark, sf, ["p_brand"]), "matching_blocks", 0.8, ["p_brand"])
    return pairs.withColumn("score", F.round("score", 4))


@entry(
    "dedup_candidates",
    recursive(with_ctes(NAMES, LCS, body="""
SELECT left_id AS left_vendor_id, right_id AS right_vendor_id, ROUND(0.55 * jw + 0.45 * ratio, 6) AS confidence,
       CASE WHEN 0.55 * jw + 0.45 * ratio >= 0.95 THEN 'AUTO_MERGE' ELSE 'STEWARD_REVIEW' END AS recommendation,
       'OPEN' AS status, ROUND(ratio, 6) AS lev_ratio, ROUND(jw, 6) AS jaro_winkler
FROM rated WHERE 0.55 * jw + 0.45 * ratio >= 0.80
UNION ALL
SELECT first_id, p_partkey, 1.0, 'AUTO_MERGE', 'OPEN', 1.0, 1.0
FROM (SELECT p_partkey, MIN(p_partkey) OVER (PARTITION BY p_name) AS first_id FROM part) WHERE p_partkey <> first_id""")),
)
def dedup_candidates(spark, sf):
    """Every part with an equal or a similar name."""
    pairs = matching.scored_pairs(table(spark, sf, "part"), "p_partkey", normalize_party("p_name"), 0.80)
    queue = matching.review_candidates(pairs, 0.95, 0.80, "vendor_id", ts(AS_OF), "data_engineer")
    signal = F.from_json("rationale", "lev_ratio double, jaro_winkler double")
    return queue.select(
        "left_vendor_id", "right_vendor_id", F.round("confidence", 6).alias("confidence"), "recommendation", "status",
        F.round(signal["lev_ratio"], 6).alias("lev_ratio"), F.round(signal["jaro_winkler"], 6).alias("jaro_winkler"),
    )


# -- review queue -------------------------------------------------------------------


def vendors(spark, sf):
    """One vendor per distinct part name."""
    return part_names(spark, sf).select(
        F.col("id").alias("vendor_id"), F.col("name").alias("vendor_name"), F.lit(1).alias("version"),
        ts("2024-01-01 00:00:00").alias("updated_at"), F.lit("loader").alias("updated_by"),
        F.lit(None).cast("timestamp_ntz").alias("approved_at"), F.lit(None).cast("string").alias("approved_by"),
    )


def queue(spark, sf):
    """Pairs by edit share; pairs with an 'old' name were rejected; waiting time follows the left id."""
    pairs = matching.similar_pairs(part_names(spark, sf), "edit", 0.6)
    score = F.round("score", 6)
    old = F.col("left_name").startswith("old") | F.col("right_name").startswith("old")
    return pairs.select(
        (F.col("left_id") * 1000000000 + F.col("right_id")).alias("review_id"),
        F.col("left_id").alias("left_vendor_id"),
        F.col("right_id").alias("right_vendor_id"),
        score.alias("confidence"),
        score_band(score, 0.7, 0.6).alias("recommendation"),
        F.when(old, "REJECTED").otherwise("OPEN").alias("status"),
        (ts("2024-02-27 00:00:00") + F.make_dt_interval(F.lit(0), F.col("left_id").cast("int"))).alias("created_at"),
        F.lit(None).cast("timestamp_ntz").alias("reviewed_at"),
        F.lit(None).cast("string").alias("reviewed_by"),
        F.lit(None).cast("string").alias("decision_notes"),
    )


QUEUE = f"""
q AS (
  SELECT least(a.id, b.id) AS l, greatest(a.id, b.id) AS r, ROUND({EDIT_SQL}, 6) AS confidence,
         a.name LIKE 'old%' OR b.name LIKE 'old%' AS old
  FROM names a JOIN names b ON a.name < b.name WHERE {EDIT_SQL} >= 0.6),
queue AS (
  SELECT l * 1000000000 + r AS review_id, l AS left_vendor_id, r AS right_vendor_id, confidence,
         CASE WHEN confidence >= 0.7 THEN 'AUTO_MERGE' ELSE 'STEWARD_REVIEW' END AS recommendation,
         CASE WHEN old THEN 'REJECTED' ELSE 'OPEN' END AS status,
         TIMESTAMP '2024-02-27' + to_hours(l) AS created_at FROM q)
"""


@entry(
    "open_reviews",
    with_ctes(NAMES, QUEUE, body="""
SELECT review_id, left_vendor_id, right_vendor_id, confidence, recommendation FROM queue WHERE status = 'OPEN'"""),
)
def open_reviews(spark, sf):
    return merging.open_items(queue(spark, sf)).select(
        "review_id", "left_vendor_id", "right_vendor_id", "confidence", "recommendation"
    )


@entry(
    "escalations",
    with_ctes(NAMES, QUEUE, body="""
SELECT review_id, ROUND((epoch_us(TIMESTAMP '2024-03-01') - epoch_us(created_at)) / 3.6e9, 2) AS open_hours, 'owner' AS escalate_to
FROM queue WHERE status = 'OPEN' AND TIMESTAMP '2024-03-01' - created_at > INTERVAL 48 HOUR"""),
)
def escalations(spark, sf):
    return merging.escalations(queue(spark, sf), AS_OF).select("review_id", "open_hours", "escalate_to")


@entry(
    "steward_decisions",
    with_ctes(NAMES, QUEUE, body="""
SELECT review_id,
       CASE WHEN status = 'OPEN' AND recommendation = 'STEWARD_REVIEW'
            THEN CASE WHEN confidence >= 0.65 THEN 'APPROVED' ELSE 'REJECTED' END ELSE status END AS status,
       CASE WHEN status = 'OPEN' AND recommendation = 'STEWARD_REVIEW' THEN 'data_steward' END AS reviewed_by,
       CASE WHEN status = 'OPEN' AND recommendation = 'STEWARD_REVIEW' THEN '2024-03-01 00:00:00' END AS reviewed_at
FROM queue"""),
)
def steward_decisions(spark, sf):
    """Decisions on all reviewable pairs: those on closed items change nothing."""
    q = queue(spark, sf)
    decisions = q.filter("recommendation = 'STEWARD_REVIEW'").select(
        "review_id",
        F.when(F.col("confidence") >= 0.65, "APPROVED").otherwise("REJECTED").alias("decision"),
        F.lit("data_steward").alias("reviewer"),
        F.lit("batch review").alias("notes"),
    )
    out = merging.decide(q, decisions, AS_OF)
    return out.select("review_id", "status", "reviewed_by", text("reviewed_at").alias("reviewed_at"))


@entry(
    "steward_decisions_fold",
    with_ctes(NAMES, QUEUE, body="""
SELECT review_id, CASE WHEN status = 'OPEN' THEN CASE WHEN left_vendor_id % 2 = 0 THEN 'APPROVED' ELSE 'REJECTED' END ELSE status END AS status,
       CASE WHEN status = 'OPEN' THEN 'first' END AS reviewed_by FROM queue"""),
)
def steward_decisions_fold(spark, sf):
    """Three decisions for each review: the first one closes it, its row stays one."""
    q = queue(spark, sf)
    turn = F.explode(F.array(*[F.lit(k) for k in (2, 1, 3)])).alias("turn")
    first = F.when(F.col("left_vendor_id") % 2 == 0, "APPROVED").otherwise("REJECTED")
    decisions = q.select("review_id", "left_vendor_id", turn).select(
        "review_id", F.when(F.col("turn") == 1, first).otherwise("ESCALATED").alias("decision"),
        F.when(F.col("turn") == 1, "first").otherwise("later").alias("reviewer"), F.lit("batch review").alias("notes"), "turn",
    )
    return merging.decide(q, decisions, AS_OF, order=["turn"]).select("review_id", "status", "reviewed_by")


MERGES = """
m AS (SELECT review_id, confidence, left_vendor_id AS s, right_vendor_id AS t FROM queue
      WHERE status = 'OPEN' AND recommendation = 'AUTO_MERGE' AND confidence >= 0.7)
"""

# Every part is a vendor; spellings of a name differ in case and punctuation.
SPELLED = "CASE p_partkey % 3 WHEN 1 THEN upper(p_name) || '.' WHEN 2 THEN p_name || '..' ELSE p_name END"
GROUPS = f"""
spelled AS (SELECT p_partkey AS vendor_id, p_name AS name, {SPELLED} AS vendor_name, MIN(p_partkey) OVER (PARTITION BY p_name) AS first_id FROM part),
pairs_of AS (SELECT s, t, confidence FROM m UNION ALL SELECT first_id, vendor_id, 1.0 FROM spelled WHERE vendor_id <> first_id),
links AS (SELECT s AS a, t AS b FROM m UNION ALL SELECT t, s FROM m),
reached(id, other) AS (SELECT id, id FROM names UNION SELECT r.id, l.b FROM reached r JOIN links l ON l.a = r.other),
roots AS (SELECT id, MIN(other) AS root FROM reached GROUP BY 1),
marks AS (SELECT v, MAX(confidence) AS best, MIN(confidence) AS worst FROM (
  SELECT s AS v, confidence FROM pairs_of UNION ALL SELECT t, confidence FROM pairs_of) GROUP BY 1),
grouped AS (SELECT vendor_id, vendor_name, root, best, worst FROM spelled JOIN roots ON first_id = id LEFT JOIN marks ON v = vendor_id),
gains AS (
  SELECT root, COUNT(*) AS merges, arg_max(vendor_name, (length(vendor_name), best, -vendor_id)) AS partner
  FROM grouped WHERE vendor_id <> root GROUP BY 1)
"""
GROUPED = recursive(with_ctes(NAMES, QUEUE, MERGES, GROUPS, body="{body}"))


def all_vendors(spark, sf):
    """Every part as a vendor, spelled in three ways."""
    spelled = F.expr("CASE p_partkey % 3 WHEN 1 THEN concat(upper(p_name), '.') WHEN 2 THEN concat(p_name, '..') ELSE p_name END")
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("vendor_id"), spelled.alias("vendor_name"), F.lit(1).alias("version"),
        ts("2024-01-01 00:00:00").alias("updated_at"), F.lit("loader").alias("updated_by"),
        F.lit(None).cast("timestamp_ntz").alias("approved_at"), F.lit(None).cast("string").alias("approved_by"),
    )


def whole_queue(spark, sf):
    """The queue of similar names with the pairs of equal names, written once."""
    similar = queue(spark, sf)
    equal = matching.same_name_pairs(all_vendors(spark, sf), "vendor_id", normalize_party("vendor_name"))
    known = {
        "review_id": F.col("first_id") * 1000000000 + F.col("other_id"), "left_vendor_id": F.col("first_id"), "right_vendor_id": F.col("other_id"),
        "confidence": F.lit(1.0), "recommendation": F.lit("AUTO_MERGE"), "status": F.lit("OPEN"), "created_at": ts("2024-02-27 00:00:00"),
    }
    both = similar.unionByName(equal.select(*[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in similar.schema]))
    path = work_dir(spark, "queue")
    both.write.parquet(path)
    return spark.read.parquet(path)


def pairwise(spark, sf):
    return merging.AutoMerge(queue(spark, sf), AS_OF, 0.7, closure=False)


def merge(spark, sf):
    return merging.AutoMerge(whole_queue(spark, sf), AS_OF, 0.7)


@entry(
    "auto_merge",
    GROUPED.format(body="""
SELECT vendor_id,
       CASE WHEN g.root IS NULL OR length(vendor_name) >= length(partner) THEN vendor_name ELSE partner END AS vendor_name,
       1 + COALESCE(merges, 0) AS version,
       CASE WHEN g.root IS NULL THEN 'loader' ELSE 'auto_merge' END AS updated_by,
       CASE WHEN g.root IS NOT NULL THEN 'auto_merge_bot' END AS approved_by
FROM spelled LEFT JOIN gains g ON vendor_id = g.root"""),
)
def auto_merge(spark, sf):
    out = merge(spark, sf).master(all_vendors(spark, sf), "vendor_name")
    return out.select("vendor_id", "vendor_name", F.col("version").cast("long").alias("version"), "updated_by", "approved_by")


def all_active(spark, sf):
    return all_vendors(spark, sf).select(
        "vendor_id", F.lit("ACTIVE").alias("lifecycle_state"), F.lit(None).cast("string").alias("state_reason"),
        "updated_at", "updated_by", "approved_at", "approved_by",
    )


@entry(
    "auto_merge_lifecycle",
    GROUPED.format(body="""
SELECT vendor_id, CASE WHEN vendor_id = root THEN 'ACTIVE' ELSE 'DEPRECATED' END AS lifecycle_state,
       CASE WHEN vendor_id <> root THEN CAST(root AS VARCHAR) END AS merged_into,
       CASE WHEN vendor_id <> root THEN ROUND(worst, 4) END AS confidence
FROM grouped"""),
)
def auto_merge_lifecycle(spark, sf):
    out = merge(spark, sf).lifecycle(all_active(spark, sf))
    why = F.col("state_reason").isNotNull()
    return out.select(
        "vendor_id", "lifecycle_state", F.when(why, F.regexp_extract("state_reason", r"vendor_id=(\d+)", 1)).alias("merged_into"),
        F.when(why, F.regexp_extract("state_reason", r"conf=([0-9.]+)", 1).try_cast("double")).alias("confidence"),
    )


@entry(
    "auto_merge_queue",
    GROUPED.format(body="""
, closed AS (
  SELECT review_id, status, left_vendor_id AS l, right_vendor_id AS r, status = 'OPEN' AND recommendation = 'AUTO_MERGE' AND confidence >= 0.7 AS hit FROM queue
  UNION ALL SELECT first_id * 1000000000 + vendor_id, 'OPEN', first_id, vendor_id, TRUE FROM spelled WHERE vendor_id <> first_id)
SELECT review_id, CASE WHEN hit THEN 'MERGED' ELSE status END AS status,
       CASE WHEN hit THEN 'Survivor=' || root || ', Deprecated=' || CASE WHEN root = l THEN '' ELSE l || ', ' END || r END AS decision_notes
FROM closed JOIN grouped ON vendor_id = l"""),
)
def auto_merge_queue(spark, sf):
    return merge(spark, sf).merged_queue().select("review_id", "status", "decision_notes")


@entry(
    "merge_groups",
    GROUPED.format(body="SELECT vendor_id AS node, root, best, worst FROM grouped WHERE best IS NOT NULL"),
)
def merge_groups(spark, sf):
    """The survivor of every vendor that any merge touches."""
    return merge(spark, sf).groups().select("node", "root", "best", "worst")


@entry(
    "chained_merges",
    with_ctes(NAMES, QUEUE, MERGES, body="SELECT DISTINCT s AS vendor_id FROM m WHERE s IN (SELECT t FROM m)"),
)
def chained_merges(spark, sf):
    return pairwise(spark, sf).chained()


@entry(
    "survivor_names",
    with_ctes(NAMES, QUEUE, MERGES, body="""
SELECT review_id, a.name AS survivor_name, b.name AS retired_name,
       CASE WHEN length(a.name) >= length(b.name) THEN a.name ELSE b.name END AS new_name
FROM m JOIN names a ON s = a.id JOIN names b ON t = b.id"""),
)
def survivor_names(spark, sf):
    named = pairwise(spark, sf).named_pairs(vendors(spark, sf), F.col("vendor_name"))
    return named.select("review_id", "survivor_name", "retired_name", "new_name")


# -- golden records -----------------------------------------------------------------


def claims(spark, sf):
    """Every order claims values for its customer; the order status is the source."""
    orders = table(spark, sf, "orders")
    source = F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2).otherwise(3)
    return orders.select(
        F.col("o_custkey").alias("customer_id"),
        source.alias("priority"),
        F.when(source > 1, F.col("o_orderpriority")).alias("borough"),
        F.when(source > 1, F.concat_ws("/", "o_orderpriority", "o_orderstatus")).alias("zone"),
        F.when((source > 1) | (F.col("o_totalprice") > 400000), F.lower("o_orderpriority")).alias("service_zone"),
    )


CLAIMS = """
claims AS (
  SELECT customer_id, priority, CASE WHEN priority > 1 THEN p END AS borough,
         CASE WHEN priority > 1 THEN p || '/' || st END AS zone,
         CASE WHEN priority > 1 OR price > 400000 THEN lower(p) END AS service_zone
  FROM (SELECT o_custkey AS customer_id, o_orderpriority AS p, o_orderstatus AS st, o_totalprice AS price,
               CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS priority FROM orders)),
freq AS (SELECT customer_id, arg_min(borough, (-n, borough)) AS borough FROM (
  SELECT customer_id, borough, COUNT(*) AS n FROM claims WHERE borough IS NOT NULL GROUP BY 1, 2) GROUP BY 1),
golden AS (
  SELECT c.customer_id, COALESCE(MIN(CASE WHEN priority <= 1 THEN c.borough END), ANY_VALUE(f.borough)) AS borough,
         COALESCE(MIN(CASE WHEN priority <= 1 THEN zone END),
                  arg_min(zone, (-length(zone), zone)) FILTER (WHERE zone IS NOT NULL)) AS zone,
         COALESCE(MIN(CASE WHEN priority <= 1 THEN service_zone END),
                  arg_min(service_zone, (priority, service_zone)) FILTER (WHERE service_zone IN ('1-urgent', '2-high'))) AS service_zone,
         COUNT(*) AS sources
  FROM claims c LEFT JOIN freq f ON c.customer_id = f.customer_id GROUP BY 1)
"""

GOLDEN_RULES = {
    "borough": FieldRule("frequent"),
    "zone": FieldRule("longest"),
    "service_zone": FieldRule("allowed", ("1-urgent", "2-high")),
}


@entry("golden_record", with_ctes(CLAIMS, body="SELECT * FROM golden"))
def golden_record(spark, sf):
    return survivorship.golden_records(claims(spark, sf), "customer_id", "priority", GOLDEN_RULES)


@entry("survivorship", with_ctes(CLAIMS, body="SELECT customer_id, zone, sources FROM golden"))
def survivorship_query(spark, sf):
    return survivorship.golden_records(claims(spark, sf), "customer_id", "priority", {"zone": FieldRule("longest")})


@entry(
    "rejected_records",
    """SELECT s_suppkey AS location_id, n_name AS zone, 'key_conflict' AS reject_reason
FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey <> n_nationkey""",
)
def rejected_records(spark, sf):
    """Suppliers that claim their own key as the id of their nation."""
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("location_id"), F.col("n_name").alias("zone"))
    claimed = table(spark, sf, "supplier").join(nation, F.col("s_nationkey") == F.col("location_id")).select(
        F.col("s_suppkey").alias("location_id"), "zone"
    )
    return survivorship.rejected_records(claimed, "location_id", nation, ["zone"])


@entry(
    "steward_flags",
    """SELECT s_suppkey, n_name, CAST(COUNT(*) OVER (PARTITION BY n_name) AS BIGINT) AS keys
FROM supplier JOIN nation ON s_nationkey = n_nationkey QUALIFY COUNT(*) OVER (PARTITION BY n_name) > 1""",
)
def steward_flags(spark, sf):
    """Suppliers of one nation, told apart by nothing but their key."""
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    rows = table(spark, sf, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name")
    return survivorship.steward_flags(rows, "s_suppkey", ["n_name"])


# -- code sets ----------------------------------------------------------------------

# Fixed labels of the payment codes.
PAYMENT_LABELS = {1: "Credit card", 2: "Cash", 3: "No charge", 4: "Dispute", 5: "Unknown", 6: "Voided trip"}


@entry("code_sets", with_ctes(TRIPS, body="SELECT DISTINCT payment_type FROM trips"))
def code_sets(spark, sf):
    return metrics.distinct_codes(trips(spark, sf), "payment_type")


CODE_MASTER = """
codes AS (SELECT DISTINCT l_linenumber AS code FROM lineitem)
"""


@entry(
    "code_set_master",
    with_ctes(CODE_MASTER, body="""
SELECT code, CASE code WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No charge' WHEN 4 THEN 'Dispute'
       WHEN 5 THEN 'Unknown' WHEN 6 THEN 'Voided trip' ELSE 'PaymentType ' || code END AS label,
       CASE WHEN code <= 3 THEN 2 ELSE 1 END AS version,
       CASE WHEN code <= 3 THEN 'loader' ELSE 'data_engineer' END AS created_by FROM codes"""),
)
def code_set_master(spark, sf):
    codes = metrics.distinct_codes(table(spark, sf, "lineitem"), "l_linenumber").withColumnRenamed("l_linenumber", "code")
    incoming = codes.withColumn("label", code_label("code", PAYMENT_LABELS, "PaymentType"))
    known = codes.filter("code <= 3").select(
        "code", F.lit("old").alias("label"), F.lit(1).alias("version"),
        ts("2024-01-01 00:00:00").alias("created_at"), F.lit("loader").alias("created_by"),
    )
    out = upsert.upsert_type1(known, incoming, ["code"], ["label"], AS_OF)
    return out.select("code", "label", "version", "created_by")


@entry(
    "code_listing",
    with_ctes(CODE_MASTER, body="SELECT code, row_number() OVER (ORDER BY code) AS position FROM codes"),
)
def code_listing(spark, sf):
    codes = metrics.distinct_codes(table(spark, sf, "lineitem"), "l_linenumber").withColumnRenamed("l_linenumber", "code")
    return metrics.number_rows(codes, "code")


# -- lifecycle ----------------------------------------------------------------------


@entry(
    "lifecycle_seed",
    with_ctes(LIFECYCLE, body="""
SELECT s_suppkey AS vendor_id, COALESCE(lifecycle_state, 'ACTIVE') AS lifecycle_state,
       COALESCE(state_reason, 'Seed active state') AS state_reason, COALESCE(updated_by, 'seed_script') AS updated_by
FROM supplier LEFT JOIN lifecycle ON s_suppkey = vendor_id"""),
)
def lifecycle_seed(spark, sf):
    master = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("vendor_id"))
    return states.seed(lifecycle(spark, sf), master, "vendor_id", AS_OF).drop("updated_at")


@entry(
    "lifecycle_check",
    with_ctes(LIFECYCLE, body="""
SELECT s_suppkey AS vendor_id, lifecycle_state AS old_state,
       CASE WHEN s_acctbal < 2000 THEN 'RETIRED' WHEN s_acctbal < 4000 THEN 'DEPRECATED'
            WHEN s_acctbal > 9000 THEN 'PROPOSED' WHEN s_acctbal > 8000 THEN 'RETIRED' ELSE 'ACTIVE' END AS new_state
FROM supplier LEFT JOIN lifecycle ON s_suppkey = vendor_id
WHERE (s_acctbal < 2000 AND lifecycle_state <> 'DEPRECATED') OR (s_acctbal > 8000 AND s_acctbal <= 9000)"""),
)
def lifecycle_check(spark, sf):
    balance = F.col("s_acctbal")
    wanted = (
        F.when(balance < 2000, "RETIRED").when(balance < 4000, "DEPRECATED").when(balance > 9000, "PROPOSED")
        .when(balance > 8000, "RETIRED").otherwise("ACTIVE")
    )
    new = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("vendor_id"), wanted.alias("lifecycle_state"))
    return states.invalid_transitions(lifecycle(spark, sf), new, "vendor_id").select("vendor_id", "old_state", "new_state")


@entry(
    "lifecycle_distribution",
    with_ctes(LIFECYCLE, body="""
SELECT COALESCE(lifecycle_state, 'UNKNOWN') AS value, COUNT(*) AS rows
FROM supplier LEFT JOIN lifecycle ON s_suppkey = vendor_id GROUP BY 1"""),
)
def lifecycle_distribution(spark, sf):
    master = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("vendor_id"))
    return metrics.value_distribution(states.with_state(master, lifecycle(spark, sf), "vendor_id"), "lifecycle_state")


@entry(
    "approval_policy",
    """WITH given AS (
  SELECT o_custkey AS change_id, COUNT(DISTINCT o_orderstatus) AS approvals, bool_or(o_orderstatus = 'O') AS by_owner
  FROM orders WHERE o_orderstatus IN ('O', 'F') AND o_totalprice > 300000 GROUP BY 1)
SELECT c_custkey AS change_id, environment, change_type, COALESCE(approvals, 0) AS approvals, required,
       CASE WHEN c_acctbal < -500 THEN 'OVERRIDDEN'
            WHEN COALESCE(approvals, 0) < required THEN 'BLOCKED_APPROVALS'
            WHEN required > 0 AND change_type <> 'attribute_change' AND NOT COALESCE(by_owner, FALSE) THEN 'BLOCKED_OWNER'
            ELSE 'APPROVED' END AS decision
FROM (SELECT *, CASE WHEN c_mktsegment = 'BUILDING' THEN 'dev' ELSE 'prod' END AS environment,
             CASE WHEN c_mktsegment = 'BUILDING' THEN 0 ELSE 1 END AS required,
             CASE WHEN c_acctbal > 4000 THEN 'schema_change' WHEN c_acctbal > 2000 THEN 'retention_policy_change'
                  ELSE 'attribute_change' END AS change_type FROM customer)
LEFT JOIN given ON c_custkey = change_id""",
)
def approval_policy(spark, sf):
    customer, orders = table(spark, sf, "customer"), table(spark, sf, "orders")
    kind = (
        F.when(F.col("c_acctbal") > 4000, "schema_change").when(F.col("c_acctbal") > 2000, "retention_policy_change")
        .otherwise("attribute_change")
    )
    changes = customer.select(
        F.col("c_custkey").alias("change_id"),
        F.when(F.col("c_mktsegment") == "BUILDING", "dev").otherwise("prod").alias("environment"),
        kind.alias("change_type"),
    )
    role = F.when(F.col("o_orderstatus") == "O", "data-owner").when(F.col("o_orderstatus") == "F", "data-steward").otherwise("guest")
    approvals = orders.filter("o_totalprice > 300000").select(F.col("o_custkey").alias("change_id"), role.alias("approver_role"))
    overrides = customer.filter("c_acctbal < 0").select(
        F.col("c_custkey").alias("change_id"), F.lit("incident").alias("reason"),
        F.when(F.col("c_acctbal") < -500, ts("2024-04-01 00:00:00")).otherwise(ts("2024-02-01 00:00:00")).alias("expires_at"),
    )
    return states.approval_decisions(
        changes, approvals, {"dev": 0, "prod": 1}, ["data-owner", "data-steward"],
        ["schema_change", "location_id_merge_or_retire", "retention_policy_change"], overrides, AS_OF,
    )
