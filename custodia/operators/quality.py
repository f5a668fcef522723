"""Rules as data: report, samples, promotion, quarantine, expectations, zero-row tests.

A rule gives a violation Column that is never NULL. All column rules of a suite
are counted in one aggregate over one scan; membership rules are counted on
per-key counts, so a hot key is reduced before it is shuffled.
"""

from __future__ import annotations

import json
import operator
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from custodia.functions import pass_fail, pct
from custodia.session import clock

# Fixed set of comparison names a rule file may use.
COMPARISONS = {
    "<=": operator.le,
    "<": operator.lt,
    ">=": operator.ge,
    ">": operator.gt,
    "==": operator.eq,
    "!=": operator.ne,
}


@dataclass(frozen=True)
class CompareColumns:
    """``a op b`` must hold. An unknown (NULL) comparison is no violation but does not pass a gate."""

    name: str
    a: str
    op: str
    b: str
    severity: str = "high"

    def violation(self) -> Column:
        return ~self._known()

    def passes(self) -> Column:
        return F.coalesce(COMPARISONS[self.op](F.col(self.a), F.col(self.b)), F.lit(False))

    def _known(self) -> Column:
        return F.coalesce(COMPARISONS[self.op](F.col(self.a), F.col(self.b)), F.lit(True))


@dataclass(frozen=True)
class NumericRange:
    """Value within [low, high], a strict bound itself left out; NULL counts as ``null_as`` (None: NULL never violates)."""

    name: str
    column: str
    low: float | None = None
    high: float | None = None
    null_as: float | None = 0
    severity: str = "medium"
    strict_low: bool = False
    strict_high: bool = False

    def violation(self) -> Column:
        value = F.col(self.column)
        if self.null_as is not None:
            value = F.coalesce(value, F.lit(self.null_as))
        bad = F.lit(False)
        if self.low is not None:
            bad = bad | ((value <= F.lit(self.low)) if self.strict_low else (value < F.lit(self.low)))
        if self.high is not None:
            bad = bad | ((value >= F.lit(self.high)) if self.strict_high else (value > F.lit(self.high)))
        return F.coalesce(bad, F.lit(False))

    def passes(self) -> Column:
        return ~self.violation()


@dataclass(frozen=True)
class NotNull:
    name: str
    column: str
    severity: str = "high"

    def violation(self) -> Column:
        return F.col(self.column).isNull()

    def passes(self) -> Column:
        return F.col(self.column).isNotNull()


@dataclass(frozen=True)
class AllowedValues:
    """Value, after lower and trim when ``normalize``, within a set; NULL is left to NotNull."""

    name: str
    column: str
    allowed: tuple[str, ...] = ()
    normalize: bool = True
    severity: str = "medium"

    def violation(self) -> Column:
        value = F.col(self.column)
        if self.normalize:
            value = F.lower(F.trim(value))
        return F.coalesce(~value.isin(*self.allowed), F.lit(False))

    def passes(self) -> Column:
        return ~self.violation()


@dataclass(frozen=True)
class Membership:
    """Non-null key must exist in ``lookup[key]``."""

    name: str
    column: str
    lookup: DataFrame = field(compare=False, repr=False)
    key: str = ""
    severity: str = "high"


def rules_from_spec(spec: Sequence[Mapping], lookups: Mapping[str, DataFrame] | None = None, spark: SparkSession | None = None, folder: str = "") -> list:
    """Rule objects from parsed rule files (a list of mappings with a ``type``).

    A membership rule names a table of ``lookups``, or as ``lookup_csv`` a CSV file with
    header below ``folder``, which ``spark`` reads. Its keys are taken as ``lookup_type``
    (a whole number, if not given); others than that are no keys.
    """
    rules = []
    for r in spec:
        kind, severity = r["type"], r.get("severity", "medium")
        if kind == "compare_columns":
            rules.append(CompareColumns(r["name"], r["column_a"], r["op"], r["column_b"], severity))
        elif kind == "numeric_range":
            rules.append(NumericRange(r["name"], r["column"], r.get("min"), r.get("max"), 0, severity))
        elif kind == "not_null":
            rules.append(NotNull(r["name"], r["column"], severity))
        elif kind == "allowed_values":
            rules.append(AllowedValues(r["name"], r["column"], tuple(r["values"]), True, severity))
        elif kind == "fk_membership":
            key = r["lookup_key"]
            if "lookup_csv" in r:
                raw = spark.read.option("header", True).csv(f"{folder.rstrip('/')}/{r['lookup_csv']}" if folder else r["lookup_csv"])
                lookup = raw.select(F.col(key).try_cast(r.get("lookup_type", "long")).alias(key))
            else:
                lookup = (lookups or {})[r["lookup"]]
            rules.append(Membership(r["name"], r["column"], lookup, key, severity))
        else:
            raise ValueError(f"unknown rule type {kind!r}")
    return rules


def rules_from_expectations(text: str) -> list:
    """Rule objects from an expectation-suite JSON document; NULL never fails a range."""
    rules = []
    for e in json.loads(text)["expectations"]:
        kind, kw = e["expectation_type"], e["kwargs"]
        name = f"{kind}:{kw['column']}"
        if kind == "expect_column_values_to_not_be_null":
            rules.append(NotNull(name, kw["column"]))
        elif kind == "expect_column_values_to_be_between":
            strict = bool(kw.get("strict_min")), bool(kw.get("strict_max"))
            rules.append(NumericRange(name, kw["column"], kw.get("min_value"), kw.get("max_value"), None, "medium", *strict))
        else:
            raise ValueError(f"unknown expectation {kind!r}")
    return rules


def _split(rules: Sequence) -> tuple[list, list]:
    column_rules = [r for r in rules if not isinstance(r, Membership)]
    return column_rules, [r for r in rules if isinstance(r, Membership)]


def _known_keys(rule: Membership, flag: str) -> DataFrame:
    key = F.col(rule.key).alias(f"{flag}_key")
    return rule.lookup.select(key).dropna().distinct().withColumn(flag, F.lit(True))


def flag_violations(df: DataFrame, rules: Sequence) -> DataFrame:
    """``df`` plus ``_bad_<i>`` per rule."""
    for i, rule in enumerate(rules):
        if isinstance(rule, Membership):
            flag = f"_known_{i}"
            df = df.join(_known_keys(rule, flag), F.col(rule.column) == F.col(f"{flag}_key"), "left")
            bad = F.col(rule.column).isNotNull() & F.col(flag).isNull()
            df = df.withColumn(f"_bad_{i}", bad).drop(flag, f"{flag}_key")
    return df.withColumns(
        {f"_bad_{i}": r.violation() for i, r in enumerate(rules) if not isinstance(r, Membership)}
    )


def partial_counts(df: DataFrame, rules: Sequence, measures: Mapping[str, Column] | None = None) -> DataFrame:
    """Rows per value of each membership column, and one row over all: counts, violations, measures.

    Grouping sets over one scan: each row is expanded once per membership column, so
    the result has as many rows as these columns have values in sum, not in product.
    ``_set`` is the grouping id: the greatest one marks the row over all.
    """
    column_rules, key_rules = _split(rules)
    keys = list(dict.fromkeys(r.column for r in key_rules))
    # violations are computed before the expansion
    flagged = df.withColumns({f"_v{i}": r.violation() for i, r in enumerate(column_rules)})
    counts = [F.count("*").alias("_n"), *[F.count_if(F.col(f"_v{i}")).alias(f"_c{i}") for i in range(len(column_rules))]]
    counts += [value.alias(name) for name, value in (measures or {}).items()]
    if not keys:
        return flagged.agg(*counts).withColumn("_set", F.lit(0).cast("long"))
    flagged = flagged.withColumns({f"_key{j}": F.col(k) for j, k in enumerate(keys)})
    groups = [F.col(f"_key{j}") for j in range(len(keys))]
    return flagged.groupingSets([[g] for g in groups] + [[]], *groups).agg(F.grouping_id().alias("_set"), *counts)


def rule_totals(df: DataFrame, rules: Sequence, measures: Mapping[str, Column] | None = None) -> tuple[DataFrame, list[tuple]]:
    """One row with ``_n``, the violations of every rule and the measures; and each rule with its column there."""
    column_rules, key_rules = _split(rules)
    keys = list(dict.fromkeys(r.column for r in key_rules))
    partial = partial_counts(df, rules, measures)
    whole = F.col("_set") == (1 << len(keys)) - 1
    none = F.lit(0)
    sums = [F.coalesce(F.sum(F.when(whole, F.col("_n"))), none).alias("_n")]
    sums += [F.coalesce(F.sum(F.when(whole, F.col(f"_c{i}"))), none).alias(f"_c{i}") for i in range(len(column_rules))]
    sums += [F.max(F.when(whole, F.col(name))).alias(name) for name in measures or {}]
    for i, rule in enumerate(key_rules):
        flag, j = f"_known_{i}", keys.index(rule.column)
        mine = F.col("_set") == (1 << len(keys)) - 1 - (1 << (len(keys) - 1 - j))
        partial = partial.join(_known_keys(rule, flag), mine & (F.col(f"_key{j}") == F.col(f"{flag}_key")), "left")
        missing = mine & F.col(f"_key{j}").isNotNull() & F.col(flag).isNull()
        sums.append(F.coalesce(F.sum(F.when(missing, F.col("_n"))), none).alias(f"_k{i}"))
    named = [(r, f"_c{i}") for i, r in enumerate(column_rules)] + [(r, f"_k{i}") for i, r in enumerate(key_rules)]
    return partial.agg(*sums), named


def quality_report(df: DataFrame, rules: Sequence) -> DataFrame:
    """One row per rule: bad_count, bad_pct (6 digits), status, over one scan of ``df``."""
    totals, named = rule_totals(df, rules)
    rows = [
        F.struct(
            F.lit(r.name).alias("check_name"),
            F.lit(r.severity).alias("severity"),
            F.col("_n").alias("row_count"),
            F.col(bad).alias("bad_count"),
            pct(F.col(bad), F.col("_n")).alias("bad_pct"),
            pass_fail(F.col(bad) == 0).alias("status"),
        )
        for r, bad in named
    ]
    return totals.select(F.inline(F.array(*rows)))


def violation_samples(
    df: DataFrame, rules: Sequence, order_by: Sequence[str], columns: Sequence[str], n: int = 10
) -> DataFrame:
    """First ``n`` violating rows per rule in a given total order.

    The rank filter is pushed below the shuffle as a per-task limit, so a rule
    that fails on every row still moves only ``n`` rows per task.
    """
    flagged = flag_violations(df, rules)
    hits = F.array_compact(
        F.array(*[F.when(F.col(f"_bad_{i}"), F.lit(r.name)) for i, r in enumerate(rules)])
    )
    kept = list(dict.fromkeys([*columns, *order_by]))
    exploded = flagged.select(F.explode(hits).alias("check_name"), *kept)
    position = F.row_number().over(Window.partitionBy("check_name").orderBy(*order_by))
    return exploded.withColumn("position", position).filter(F.col("position") <= n)


def promote(df: DataFrame, rules: Sequence) -> DataFrame:
    """Rows that definitely pass every column rule."""
    for rule in rules:
        df = df.filter(rule.passes())
    return df


def promote_observed(df: DataFrame, rules: Sequence, name: str = "gate") -> tuple[DataFrame, Observation, Observation]:
    """Promotion with rows_in and rows_out counted while the result is written: no extra scan."""
    seen_in, seen_out = Observation(f"{name}_in"), Observation(f"{name}_out")
    good = promote(df.observe(seen_in, F.count(F.lit(1)).alias("rows_in")), rules)
    return good.observe(seen_out, F.count(F.lit(1)).alias("rows_out")), seen_in, seen_out


def gate_accounting(df: DataFrame, rules: Sequence) -> DataFrame:
    """rows_in, rows_out, rows_dropped in one pass."""
    ok = F.lit(True)
    for rule in rules:
        ok = ok & rule.passes()
    return df.agg(F.count("*").alias("rows_in"), F.count_if(ok).alias("rows_out")).withColumn(
        "rows_dropped", F.col("rows_in") - F.col("rows_out")
    )


def with_reasons(df: DataFrame, rules: Sequence) -> DataFrame:
    """``df`` plus the names of the rules each row does not pass."""
    column_rules, _ = _split(rules)
    if len(column_rules) == len(rules):
        failed = [F.when(~r.passes(), F.lit(r.name)) for r in rules]
        return df.withColumn("reasons", F.array_compact(F.array(*failed)))
    flagged = flag_violations(df, rules)
    failed = [
        F.when(F.col(f"_bad_{i}") if isinstance(r, Membership) else ~r.passes(), F.lit(r.name))
        for i, r in enumerate(rules)
    ]
    return flagged.withColumn("reasons", F.array_compact(F.array(*failed))).drop(
        *[f"_bad_{i}" for i in range(len(rules))]
    )


def quarantine(df: DataFrame, rules: Sequence) -> DataFrame:
    """Rows that fail at least one rule, with reasons."""
    return with_reasons(df, rules).filter(F.size("reasons") > 0)


def expectation_results(df: DataFrame, rules: Sequence) -> DataFrame:
    """Per expectation: success, evaluated elements, unexpected count and percent of them."""
    exprs, rows = [F.count("*").alias("_n")], []
    for i, r in enumerate(rules):
        exprs.append(F.count_if(r.violation()).alias(f"_c{i}"))
        ranged = isinstance(r, NumericRange) and r.null_as is None
        if ranged:
            exprs.append(F.count(r.column).alias(f"_e{i}"))
        seen = F.col(f"_e{i}") if ranged else F.col("_n")
        bad = F.col(f"_c{i}")
        rows.append(
            F.struct(
                F.lit(r.name).alias("expectation"),
                (bad == 0).alias("success"),
                seen.alias("element_count"),
                bad.alias("unexpected_count"),
                pct(bad, seen).alias("unexpected_percent"),
            )
        )
    return df.agg(*exprs).select(F.inline(F.array(*rows)))


def zero_row_tests(tests: Mapping[str, tuple[DataFrame, str]], run_id: str, as_of: str) -> DataFrame:
    """Result log rows for tests given as {name: (failing rows, details)}."""
    results = None
    for name, (failing, details) in tests.items():
        row = failing.agg(F.count("*").alias("failing_rows")).select(
            F.lit(run_id).alias("run_id"),
            F.lit(name).alias("test_name"),
            pass_fail(F.col("failing_rows") == 0).alias("status"),
            "failing_rows",
            F.lit(details).alias("details"),
            clock(as_of).alias("ran_at"),
        )
        results = row if results is None else results.unionByName(row)
    return results


def zero_row_conditions(
    df: DataFrame, tests: Mapping[str, tuple[Column, str]], run_id: str, as_of: str
) -> DataFrame:
    """``zero_row_tests`` for tests on one table, given as {name: (condition of a failing row, details)}: one scan."""
    counts = [F.count_if(F.coalesce(bad, F.lit(False))).alias(f"_f{i}") for i, (bad, _) in enumerate(tests.values())]
    rows = [
        F.struct(
            F.lit(run_id).alias("run_id"),
            F.lit(name).alias("test_name"),
            pass_fail(F.col(f"_f{i}") == 0).alias("status"),
            F.col(f"_f{i}").alias("failing_rows"),
            F.lit(details).alias("details"),
            clock(as_of).alias("ran_at"),
        )
        for i, (name, (_, details)) in enumerate(tests.items())
    ]
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def log_tests(results: DataFrame, path: str, run_id: str) -> DataFrame:
    """Add a run's test results to the log below ``path``; results of an earlier attempt of the run are replaced, other runs stay.

    The log has one folder per run. Gives the results of this run as stored.
    """
    spark = results.sparkSession
    one = f"{path.rstrip('/')}/run_id={quote(run_id, safe='')}"
    results.drop("run_id").coalesce(1).write.mode("overwrite").parquet(one)
    return spark.read.parquet(one).withColumn("run_id", F.lit(run_id)).select(*results.columns)


def test_log(spark: SparkSession, path: str) -> DataFrame:
    """The results of all runs."""
    return spark.read.option("basePath", path).parquet(path).withColumn("run_id", F.col("run_id").cast("string"))


def raise_on_failure(results: DataFrame) -> None:
    """Raise after all tests were logged; one row per test reaches the driver."""
    failed = results.filter("status = 'FAIL'").select("test_name", "failing_rows").collect()
    if failed:
        raise AssertionError("; ".join(f"{r['test_name']}: {r['failing_rows']} failing rows" for r in failed))


def lookup_gate(
    df: DataFrame, key: str, required: Sequence[str], value_col: str, allowed: Sequence[str], max_bad_pct: float
) -> DataFrame:
    """Gate of a reference file in one aggregate.

    ``bad_total`` adds rule violations (a row may count several times);
    ``bad_rows`` counts distinct rows with a NULL or a value outside the set.
    """
    outside = AllowedValues("allowed", value_col, tuple(allowed)).violation()
    any_bad = outside
    for c in [key, *required]:
        any_bad = any_bad | F.col(c).isNull()
    null_counts = [F.count_if(F.col(c).isNull()).alias(f"{c}_null_bad") for c in [key, *required]]
    one = df.agg(
        F.count("*").alias("total_rows"),
        *null_counts,
        F.count_if(outside).alias(f"{value_col}_allowed_bad"),
        F.count_distinct(key).alias("_distinct"),
        F.count_if(any_bad).alias("bad_rows"),
    )
    # NULL is one distinct key value.
    distinct = F.col("_distinct") + F.when(F.col(f"{key}_null_bad") > 0, 1).otherwise(0)
    one = one.withColumn(f"{key}_duplicates_bad", F.col("total_rows") - distinct).drop("_distinct")
    names = [f"{c}_null_bad" for c in [key, *required]] + [f"{value_col}_allowed_bad", f"{key}_duplicates_bad"]
    total = sum((F.col(n) for n in names[1:]), F.col(names[0]))
    one = one.withColumn("bad_total", total).withColumn("bad_pct", pct(F.col("bad_total"), F.col("total_rows")))
    return one.withColumn("threshold_max_bad_pct", F.lit(float(max_bad_pct))).withColumn(
        "status", pass_fail(F.col("bad_pct") <= F.col("threshold_max_bad_pct"))
    )


def scorecard(measures: Sequence[tuple[DataFrame, Sequence[tuple[str, str, str, float, str, str]]]]) -> DataFrame:
    """Scorecard rows.

    Each entry is a one-row DataFrame and the dimensions measured by it: (value
    column, dimension, op, threshold, owner, action on failure). Each DataFrame is
    computed once, however many dimensions it serves.
    """
    out = None
    for df, dimensions in measures:
        rows = []
        for value, dimension, op, threshold, owner, action in dimensions:
            held = F.coalesce(COMPARISONS[op](F.col(value), F.lit(threshold)), F.lit(False))
            rows.append(
                F.struct(
                    F.lit(dimension).alias("dimension"),
                    F.col(value).cast("double").alias("measured"),
                    F.lit(f"{op} {threshold}").alias("threshold"),
                    pass_fail(held).alias("status"),
                    F.lit(owner).alias("owner"),
                    F.when(~held, F.lit(action)).alias("action"),
                )
            )
        part = df.select(F.inline(F.array(*rows)))
        out = part if out is None else out.unionByName(part)
    return out
