"""Scalar building blocks used by the operators, as Column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: stands for NULL inside a row hash, so (A, NULL, B) and (A, B, NULL) differ.
NULL_TOKEN = "\u0001"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def duration_minutes(start: Column | str, end: Column | str) -> Column:
    """Fractional minutes between two times (negative when reversed)."""
    return F.timestamp_diff("MICROSECOND", _col(start), _col(end)) / F.lit(6e7)


def age_hours(then: Column | str, as_of: Column | str) -> Column:
    return F.round(F.timestamp_diff("MICROSECOND", _col(then), _col(as_of)) / F.lit(3.6e9), 2)


def date_attributes(d: Column | str) -> dict[str, Column]:
    """Calendar attributes; day_of_week counts from 0 = Sunday."""
    d = _col(d)
    return {
        "year": F.year(d),
        "month": F.month(d),
        "day": F.dayofmonth(d),
        "day_of_week": F.dayofweek(d) - 1,
    }


def mask_email(c: Column | str) -> Column:
    """First character, three stars, domain. NULL stays NULL; text without @ is unchanged."""
    return F.regexp_replace(_col(c), "(^.).*(@.*$)", "$1***$2")


def code_label(code: Column | str, labels: Mapping[int, str], default_prefix: str) -> Column:
    """Label of a code, or '<prefix> <code>' for codes without one."""
    code = _col(code)
    fallback = F.concat(F.lit(f"{default_prefix} "), code.cast("string"))
    if not labels:
        return fallback
    pairs = [F.lit(x) for item in labels.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), code.cast("int")), fallback)


def row_hash(cols: Sequence[str], separator: str = "||") -> Column:
    """SHA-256 over the attributes with a stand-in for NULL."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_TOKEN)) for c in cols]
    return F.sha2(F.concat_ws(separator, *parts), 256)


def score_band(score: Column | str, auto: float, review: float) -> Column:
    score = _col(score)
    return (
        F.when(score >= auto, "AUTO_MERGE")
        .when(score >= review, "STEWARD_REVIEW")
        .otherwise("MANUAL")
    )


def pass_fail(ok: Column) -> Column:
    return F.when(ok, "PASS").otherwise("FAIL")


def pct(part: Column, whole: Column, digits: int = 6) -> Column:
    """Percentage that is 0 for an empty whole."""
    return F.round(F.when(whole > 0, part * F.lit(100.0) / whole).otherwise(F.lit(0.0)), digits)


def to_document(*cols: str) -> Column:
    """Columns as one JSON text; NULL fields are kept as nulls."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def json_number(c: Column | str, path: str) -> Column:
    """Number at a JSON path; text that is no number gives NULL."""
    return F.get_json_object(_col(c), path).try_cast("double")


def iso_timestamp(c: Column | str) -> Column:
    """ISO-8601 text to a UTC timestamp without zone; bad text gives NULL."""
    local = F.try_to_timestamp(_col(c)).cast("timestamp_ntz")
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), local)
