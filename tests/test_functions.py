from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from custodia.functions import (
    age_hours, code_label, duration_minutes, iso_timestamp, json_number, mask_email, normalize_party, normalize_place,
    row_hash, score_band,
)
from custodia.functions.similarity import (
    blended_of, common_subsequence, indel_ratio_of, jaro_winkler_of, matching_blocks_of,
)
from custodia.session import ts


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


@pytest.mark.parametrize(
    "a, b, jw",
    [("MARTHA", "MARHTA", 0.961111), ("DIXON", "DICKSONX", 0.813333), ("DWAYNE", "DUANE", 0.84), ("abc", "xyz", 0.0), ("", "", 1.0), ("a", "", 0.0)],
)
def test_jaro_winkler_known_values(a, b, jw):
    assert jaro_winkler_of(a, b) == pytest.approx(jw, abs=1e-6)
    assert jaro_winkler_of(b, a) == pytest.approx(jw, abs=1e-6)


def test_no_prefix_boost_for_weak_jaro():
    # Jaro of these is below 0.7, so the common first letter adds nothing
    assert jaro_winkler_of("abcd", "axyz") == pytest.approx((1 / 4 + 1 / 4 + 1) / 3)


def test_indel_ratio_is_not_levenshtein():
    # one substitution costs an insertion and a deletion
    assert indel_ratio_of("abcd", "abxd") == pytest.approx(0.75)
    assert indel_ratio_of("", "") == 1.0


def test_blend():
    assert blended_of("same", "same") == pytest.approx(1.0)
    assert blended_of("MARTHA", "MARHTA") == pytest.approx(0.55 * 0.9611111 + 0.45 * 10 / 12, abs=1e-6)


def slow_lcs(a, b):
    line = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(line[j] + 1 if x == y else max(line[j + 1], new[-1]))
        line = new
    return line[-1]


@settings(max_examples=300, deadline=None)
@given(st.text("abcd ", max_size=80), st.text("abcd ", max_size=80))
def test_common_subsequence_equals_dynamic_programming(a, b):
    assert common_subsequence(a, b) == slow_lcs(a, b)
    # matching blocks are a common subsequence: the bound the join filter rests on
    assert matching_blocks_of(a, b) <= indel_ratio_of(a, b) + 1e-12


def test_normalizers_differ_in_order(spark):
    text = F.lit("  Governor's - Island \t X ")
    assert one(spark, normalize_place(text), normalize_party(text)) == ("governors  island x", "governors island x")
    tail = F.lit("Acme , Inc .")
    # stripping punctuation last leaves a double blank, stripping it first a trailing one
    assert one(spark, normalize_place(tail), normalize_party(tail)) == ("acme  inc ", "acme inc ")
    assert one(spark, normalize_place(F.lit(None)), normalize_party(F.lit(None).cast("string"))) == ("", "")


def test_row_hash_tells_null_positions_apart(spark):
    df = spark.createDataFrame([("A", None, "B"), ("A", "B", None)], "x string, y string, z string")
    assert df.select(row_hash(["x", "y", "z"])).distinct().count() == 2


def test_masks_codes_and_times(spark):
    assert one(spark, mask_email(F.lit("bob@x.org")), mask_email(F.lit(None).cast("string"))) == ("b***@x.org", None)
    assert one(spark, code_label(F.lit(1), {1: "Cash"}, "PaymentType"), code_label(F.lit(9), {1: "Cash"}, "PaymentType")) == ("Cash", "PaymentType 9")
    assert one(spark, duration_minutes(ts("2024-01-01 00:00:00"), ts("2024-01-01 00:10:30"))) == (10.5,)
    assert one(spark, age_hours(ts("2024-01-01 00:00:00"), ts("2024-01-02 06:20:00"))) == (30.33,)
    assert one(spark, iso_timestamp(F.lit("2024-01-01T05:00:00+02:00")), iso_timestamp(F.lit("soon"))) == (datetime(2024, 1, 1, 3), None)
    assert one(spark, json_number(F.lit('{"a": {"b": "1.5"}}'), "$.a.b"), json_number(F.lit('{"a": "x"}'), "$.a")) == (1.5, None)


def test_score_bands_at_the_limits(spark):
    scores = [F.lit(x) for x in (0.95, 0.949, 0.80, 0.799)]
    assert one(spark, *[score_band(s, 0.95, 0.80) for s in scores]) == ("AUTO_MERGE", "STEWARD_REVIEW", "STEWARD_REVIEW", "MANUAL")
