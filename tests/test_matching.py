import random

import pytest
from pyspark.sql import functions as F

from custodia.functions import normalize_party
from custodia.functions.similarity import blended_of, indel_ratio_of, jaro_winkler_of, matching_blocks_of
from custodia.operators import matching
from custodia.plans import vendor_dedup_job, zone_duplicates_job


def levenshtein(a, b):
    line = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, line[j] + 1, line[j - 1] + (x != y)))
        line = new
    return line[-1]


BRUTE = {
    "matching_blocks": matching_blocks_of,
    "indel": indel_ratio_of,
    "edit": lambda a, b: 1.0 - levenshtein(a, b) / max(len(a), len(b)),
    "jaro_winkler": jaro_winkler_of,
    "blended": blended_of,
}


def random_names(seed, n=160):
    rng = random.Random(seed)
    words = ["acme", "taxi", "metro", "city", "yellow", "cab", "co", "llc", "north", "south", "a", "x1", "99"]
    names = set()
    while len(names) < n:
        text = " ".join(rng.choice(words) for _ in range(rng.randint(1, 3)))
        for _ in range(rng.randint(0, 2) if len(text) > 2 else 0):
            i = rng.randrange(len(text))
            text = text[:i] + rng.choice(["", rng.choice("abcxyz19 "), text[i] * 2]) + text[i + 1:]
        text = text.strip()
        if text:
            names.add(text)
    # very short names take the single-character path of the filter
    return sorted(names | {"a", "b", "ab", "ba", "abc", "aab", "z"})


@pytest.mark.parametrize(
    "measure, threshold, hot",
    [("matching_blocks", 0.92, 20000), ("matching_blocks", 0.7, 5), ("indel", 0.75, 20000), ("edit", 0.6, 3),
     ("jaro_winkler", 0.88, 20000), ("blended", 0.80, 10), ("blended", 0.95, 20000)],
)
def test_similarity_join_loses_and_repeats_no_pair(spark, measure, threshold, hot):
    """Also with a tiny hot limit, so that signatures are cut into slices."""
    names = random_names(len(measure) + int(threshold * 100))
    df = spark.createDataFrame(list(enumerate(names)), "id long, name string")
    reduced = matching.distinct_names(df, "id", F.col("name"))
    found = matching.similar_pairs(reduced, measure, threshold, hot_rows=hot).collect()
    ids = {n: i for i, n in enumerate(names)}
    expected = {}
    for i, a in enumerate(names):
        for b in names[i + 1:]:
            score = BRUTE[measure](a, b)
            if score >= threshold:
                expected[(min(ids[a], ids[b]), max(ids[a], ids[b]))] = score
    got = {(r["left_id"], r["right_id"]): r["score"] for r in found}
    assert got == pytest.approx(expected)
    assert len(found) == len(got)
    assert expected


@pytest.mark.parametrize("measure, threshold", [("matching_blocks", 0.92), ("indel", 0.9), ("edit", 0.8), ("jaro_winkler", 0.9), ("blended", 0.95), ("blended", 0.8)])
def test_long_names_among_short_ones(spark, measure, threshold):
    """A name of 1,000 characters and near copies of it, beside names of every band; brute force over all pairs."""
    rng = random.Random(7)
    base = "".join(rng.choice("abcdefgh ") for _ in range(1000)).strip()
    names = {base, base[:-1] + "x", "q" + base, base[:500] + base[510:], base[3:]}
    for n in (1, 2, 5, 12, 31, 32, 33, 36, 40, 47, 63, 64, 65, 100):
        one = "".join(rng.choice("abcdefghij") for _ in range(n))
        names |= {one, one[: n // 2] + "zz" + one[n // 2 :], one[1:] or "k", one + "y", "w" + one[:-1], one[: n // 3] + one[n // 3 + 2 :] or "m"}
    names = sorted(names)
    reduced = matching.distinct_names(spark.createDataFrame(list(enumerate(names)), "id long, name string"), "id", F.col("name"))
    found = {(r["left_id"], r["right_id"]) for r in matching.similar_pairs(reduced, measure, threshold).collect()}
    assert found == {(i, j) for i, a in enumerate(names) for j, b in enumerate(names) if i < j and BRUTE[measure](a, b) >= threshold}


@pytest.mark.parametrize("measure, threshold", [("edit", 0.8), ("indel", 0.9), ("matching_blocks", 0.92), ("blended", 0.95)])
def test_compared_pairs_grow_with_the_names(spark, measure, threshold):
    """Twice as many names of one alphabet and length make about twice as many pairs that meet, not four times."""
    rng = random.Random(3)

    def names(n):
        out = set()
        while len(out) < n:
            one = "".join(rng.choice("eariotnslcudpmhgbfyw") for _ in range(rng.randint(18, 24)))
            out |= {one, one[:9] + "x" + one[9:]}
        return spark.createDataFrame(list(enumerate(sorted(out))), "id long, name string")

    met = [
        matching.candidate_pairs(matching.distinct_names(names(n), "id", F.col("name")), measure, threshold).count() for n in (8_000, 16_000)
    ]
    assert met[0] >= 3_500 and met[1] < 2.6 * met[0]


def test_too_low_threshold_is_refused(spark):
    df = spark.createDataFrame([(1, "a")], "id long, name string")
    with pytest.raises(ValueError):
        matching.similar_pairs(matching.distinct_names(df, "id", F.col("name")), "jaro_winkler", 0.5)


def test_empty_and_null_names_are_left_out(spark):
    df = spark.createDataFrame([(1, None), (2, " - "), (3, "Acme"), (4, "ACME.")], "id long, name string")
    names = matching.distinct_names(df, "id", F.trim(normalize_party("name"))).collect()
    assert [(r["name"], r["id"], r["members"]) for r in names] == [("acme", 3, 2)]


def test_comparison_counts(spark, rows):
    df = spark.createDataFrame([("x", i) for i in range(5)] + [("y", 9)], "block string, id int")
    assert rows(matching.comparison_counts(df, ["block"])) == [("x", 5, 10), ("y", 1, 0)]


# Public zone names: the two exact groups, the eight similar pairs and some neighbours.
ZONES = [
    (21, "Brooklyn", "Bensonhurst East", "Boro Zone"), (22, "Brooklyn", "Bensonhurst West", "Boro Zone"),
    (56, "Queens", "Corona", "Boro Zone"), (57, "Queens", "Corona", "Boro Zone"),
    (103, "Manhattan", "Governor's Island/Ellis Island/Liberty Island", "Yellow Zone"),
    (104, "Manhattan", "Governor's Island/Ellis Island/Liberty Island", "Yellow Zone"),
    (105, "Manhattan", "Governor's Island/Ellis Island/Liberty Island", "Yellow Zone"),
    (140, "Manhattan", "Lenox Hill East", "Yellow Zone"), (141, "Manhattan", "Lenox Hill West", "Yellow Zone"),
    (142, "Manhattan", "Lincoln Square East", "Yellow Zone"), (143, "Manhattan", "Lincoln Square West", "Yellow Zone"),
    (218, "Queens", "Springfield Gardens North", "Boro Zone"), (219, "Queens", "Springfield Gardens South", "Boro Zone"),
    (227, "Brooklyn", "Sunset Park East", "Boro Zone"), (228, "Brooklyn", "Sunset Park West", "Boro Zone"),
    (236, "Manhattan", "Upper East Side North", "Yellow Zone"), (237, "Manhattan", "Upper East Side South", "Yellow Zone"),
    (238, "Manhattan", "Upper West Side North", "Yellow Zone"), (239, "Manhattan", "Upper West Side South", "Yellow Zone"),
    (262, "Manhattan", "Yorkville East", "Yellow Zone"), (263, "Manhattan", "Yorkville West", "Yellow Zone"),
    (264, "Unknown", None, None), (265, None, "Outside of NYC", None),
]


def test_zone_duplicates(spark, rows):
    zones = spark.createDataFrame(ZONES, "location_id int, borough string, zone string, service_zone string")
    exact, fuzzy = zone_duplicates_job(zones, "location_id", "borough", "zone", "service_zone")
    assert rows(exact, "location_id") == [(103,), (104,), (105,), (56,), (57,)]
    assert sorted((r["left_id"], r["right_id"], r["score"]) for r in fuzzy.collect()) == [
        (21, 22, 0.9375), (140, 141, 0.9333), (142, 143, 0.9474), (218, 219, 0.92),
        (227, 228, 0.9375), (236, 238, 0.9524), (237, 239, 0.9524), (262, 263, 0.9286),
    ]


def test_vendor_dedup_job(spark, tmp_path, rows):
    master = spark.createDataFrame(
        [(1, "Creative Mobile Technologies, LLC", 1), (2, "Creative Mobile Technologies LLC.", 1), (3, "VeriFone Inc", 1),
         (4, "Verifone Inc.", 1), (5, "Curb Mobility", 1), (6, None, 1), (7, "Creative Mobile Technology LLC", 1)],
        "vendor_id long, vendor_name string, version int",
    )
    for c, t in (("updated_at", "timestamp_ntz"), ("updated_by", "string"), ("approved_at", "timestamp_ntz"), ("approved_by", "string")):
        master = master.withColumn(c, F.lit(None).cast(t))
    life = master.select("vendor_id", F.lit("ACTIVE").alias("lifecycle_state"), F.lit(None).cast("string").alias("state_reason"),
                         "updated_at", "updated_by", "approved_at", "approved_by")
    out = vendor_dedup_job(master, life, "vendor_id", "vendor_name", "2024-03-01 00:00:00", str(tmp_path))
    # 1 and 2, 3 and 4 have equal normalized names; 1 and 7 are similar
    merged = [(a, b, "MERGED", "AUTO_MERGE") for a, b in ((1, 2), (1, 7), (3, 4))]
    assert rows(out["queue"], "left_vendor_id", "right_vendor_id", "status", "recommendation") == merged
    assert ("Creative Mobile Technologies, LLC", 3) in rows(out["master"].filter("vendor_id = 1"), "vendor_name", "version")
    assert rows(out["lifecycle"].filter("lifecycle_state = 'DEPRECATED'"), "vendor_id") == [(2,), (4,), (7,)]
    pairs = matching.same_name_pairs(master, "vendor_id", normalize_party("vendor_name"))
    assert rows(pairs, "first_id", "other_id") == [(1, 2), (3, 4)]


def test_equal_names_are_queued_and_merged(spark, tmp_path, rows):
    names = [(3, "VeriFone Inc"), (4, "Verifone Inc."), (5, "VeriFone Incs"), (9, "Other"), (10, ""), (11, "")]
    master = spark.createDataFrame([(k, n, 1, None, None, None, None) for k, n in names], MASTER)
    life = master.selectExpr("vendor_id", "'ACTIVE' AS lifecycle_state", "CAST(NULL AS STRING) AS state_reason", "updated_at", "updated_by", "approved_at", "approved_by")
    out = vendor_dedup_job(master, life, "vendor_id", "vendor_name", "2024-03-01 00:00:00", str(tmp_path))
    queued = {(r["left_vendor_id"], r["right_vendor_id"]): r for r in spark.read.parquet(f"{tmp_path}/queue").collect()}
    assert set(queued) == {(3, 4), (3, 5)}
    assert (queued[3, 4]["confidence"], queued[3, 4]["recommendation"]) == (1.0, "AUTO_MERGE")
    states = dict(rows(out["lifecycle"], "vendor_id", "lifecycle_state"))
    assert states[4] == "DEPRECATED" and states[3] == states[9] == "ACTIVE"


MASTER = "vendor_id int, vendor_name string, version int, updated_at timestamp_ntz, updated_by string, approved_at timestamp_ntz, approved_by string"
