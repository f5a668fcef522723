"""Duplicate detection: exact groups and exact similarity joins.

A similarity join never compares all pairs. Names are reduced to distinct
normalized names first. Two names can only reach the threshold when they share
enough characters (counted with multiplicity); with the characters of every name
in one global order, rarest first, such names share at least k characters in a
short prefix. Names are joined on the k-sets of characters of their prefixes, so
the filter loses no match, and only survivors of native overlap checks reach the
scoring UDF. The higher the threshold, the larger the k that pays off.

Where a measure and its threshold bound the edits between two names closely enough
(``Measure.edits``), names are joined on pieces of text instead. The shorter name is
cut into one piece more than there can be edits, so one piece stands unchanged in
the longer name, moved by the edits at most. The key is (length band, piece, place in
blocks of twice that move), so lists stay short when names multiply, and a name of n
characters has rows in the order of n, however long it is.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from math import ceil, comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custodia.functions import blended_confidence, indel_ratio, jaro_winkler, matching_blocks_ratio, name_signals, score_band
from custodia.functions.similarity import JARO_WINKLER_SHARE, PREFIX_LENGTH, PREFIX_WEIGHT, RATIO_SHARE
from custodia.session import work_dir

# Fixed value: letters of Latin-script names from frequent to rare. Any order keeps the join exact.
FREQUENT_FIRST = " eariotnslcudpmhgbfywkvxzjq"
RARE_LAST_CODES = "~zyxwvutsrqponmlkjihgfedcba"
EPS = 1e-9
# Signatures a name of typical length may have.
TYPICAL_LENGTH = 20
SIGNATURE_BUDGET = 40
# Later occurrences sort before all first ones.
OCCURRENCE_STEP = 1 << 21


@dataclass(frozen=True)
class Edits:
    """Two names of lengths n <= m that reach a threshold: m <= reach * n, and at most short * n + long * m edits part them."""

    reach: float
    short: float
    long: float

    def selective(self) -> bool:
        """Whether the pieces of a name of typical length have three characters or more."""
        most = int(self.short * TYPICAL_LENGTH + self.long * int(self.reach * TYPICAL_LENGTH))
        return TYPICAL_LENGTH // (most + 1) >= 3


def _indel_edits(ratio: float) -> Edits | None:
    """A ratio 2c / (n + m) of common characters in order leaves n + m - 2c insertions and deletions."""
    return Edits((2.0 - ratio) / ratio, 1.0 - ratio, 1.0 - ratio) if ratio > 0.5 else None


@dataclass(frozen=True)
class Measure:
    """A score with the bound the join filter needs.

    ``least(t)``: share of its own characters a name must have in common with
    any partner. ``overlap(a, b, t)``: characters two names of lengths a and b
    must have in common to reach t. ``signals``: a struct with ``score`` and what it
    is made of, where a pair keeps these. ``edits(t)``: the bound on edits, if there is one.
    """

    score: Callable[[Column, Column], Column]
    least: Callable[[float], float]
    overlap: Callable[[Column, Column, float], Column]
    signals: Callable[[str, str], Column] | None = None
    edits: Callable[[float], Edits | None] = lambda t: None


def _edit_share(a: Column, b: Column) -> Column:
    return 1.0 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b))


# Jaro <= (c/a + c/b + 1) / 3 and Jaro-Winkler <= (1 - boost) * Jaro + boost.
_BOOST = PREFIX_WEIGHT * PREFIX_LENGTH


def _jw_shares(t: float) -> float:
    """c/a + c/b needed for a Jaro-Winkler score of t."""
    return 3.0 * (t - _BOOST) / (1.0 - _BOOST) - 1.0


# blended <= _PER_SHARE * (c/a + c/b) + 2 * RATIO_SHARE * c / (a + b) + _FREE
_PER_SHARE = JARO_WINKLER_SHARE * (1.0 - _BOOST) / 3.0
_FREE = JARO_WINKLER_SHARE * ((1.0 - _BOOST) / 3.0 + _BOOST)


def _blended_least(t: float) -> float:
    """Root of the bound for a partner that consists of common characters only."""
    low, high = 0.0, 1.0
    for _ in range(60):
        r = (low + high) / 2
        if _PER_SHARE * (r + 1.0) + 2.0 * RATIO_SHARE * r / (1.0 + r) + _FREE < t:
            low = r
        else:
            high = r
    return low


MEASURES = {
    "matching_blocks": Measure(
        matching_blocks_ratio, lambda t: t / (2.0 - t), lambda a, b, t: F.lit(t / 2.0) * (a + b), edits=_indel_edits
    ),
    "indel": Measure(indel_ratio, lambda t: t / (2.0 - t), lambda a, b, t: F.lit(t / 2.0) * (a + b), edits=_indel_edits),
    "edit": Measure(
        _edit_share, lambda t: t, lambda a, b, t: F.lit(t) * F.greatest(a, b), edits=lambda t: Edits(1.0 / t, 0.0, 1.0 - t) if t > 0 else None
    ),
    "jaro_winkler": Measure(
        jaro_winkler, lambda t: _jw_shares(t) - 1.0, lambda a, b, t: F.lit(_jw_shares(t)) * a * b / (a + b)
    ),
    "blended": Measure(
        blended_confidence,
        _blended_least,
        lambda a, b, t: F.lit(t - _FREE)
        / (F.lit(_PER_SHARE) * (1.0 / a + 1.0 / b) + F.lit(2.0 * RATIO_SHARE) / (a + b)),
        name_signals,
        # the other signal is 1 at most
        lambda t: _indel_edits((t - JARO_WINKLER_SHARE) / RATIO_SHARE),
    ),
}


def distinct_names(df: DataFrame, id_col: str, name: Column, block: Sequence[str] = ()) -> DataFrame:
    """One row per (block, non-empty normalized name): smallest id and member count."""
    return (
        df.select(*block, F.col(id_col).alias("_id"), name.alias("name"))
        .filter(F.col("name") != "")
        .groupBy(*block, "name")
        .agg(F.min("_id").alias("id"), F.count("*").alias("members"))
    )


def _tokens(name: Column) -> Column:
    """Characters with occurrence numbers as ascending numbers, rarest first: 'aba' -> a, b, second a."""
    ranked = F.split(F.translate(name, FREQUENT_FIRST, RARE_LAST_CODES), "")

    def token(ch: Column, i: Column) -> Column:
        earlier = F.size(F.filter(F.slice(ranked, F.lit(1), i), lambda x: x == ch))
        return F.ascii(ch).cast("long") - earlier.cast("long") * OCCURRENCE_STEP

    return F.sort_array(F.transform(ranked, token))


def _mask(tokens: Column) -> Column:
    """64-bit set of hashed tokens: a bit of one name that the other lacks is a token the other lacks."""
    return F.aggregate(
        tokens,
        F.lit(0).cast("long"),
        lambda acc, t: acc.bitwiseOR(
            F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(t), F.lit(64)).cast("int"))
        ),
    )


def _set_size(least: float) -> int:
    """Largest k of 2..5 whose k-sets of a typical prefix stay within the budget."""
    loose = ceil(TYPICAL_LENGTH * (1.0 - least))
    return max([k for k in (3, 4, 5) if comb(loose + k, k) <= SIGNATURE_BUDGET], default=2)


def _sets_of(tokens: str, k: int) -> Column:
    """Hashes of all k-sets of an ascending token array column.

    Works on positions, so no level copies the array again.
    """
    array = F.col(tokens)
    none = F.array().cast("array<int>")

    def after(i: Column | int) -> Column:
        return F.when(F.size(array) > i, F.sequence(F.lit(i) + 1 if isinstance(i, int) else i + 1, F.size(array))).otherwise(none)

    def sets(i: Column | int, left: int) -> Column:
        if left == 1:
            return F.transform(after(i), lambda p: F.xxhash64(F.element_at(array, p)))
        return F.flatten(
            F.transform(
                after(i),
                lambda p: F.transform(sets(p, left - 1), lambda rest: F.xxhash64(F.element_at(array, p), rest)),
            )
        )

    return sets(0, k)


# What a signature row holds of its name; the rest is joined to the few pairs that meet.
CARRIED = ("row", "length", "mask")
# Longer names, and names that can match such, meet under sets of two: more characters would make too many sets.
LONG = 64


def _sized(names: DataFrame, least: float) -> DataFrame:
    """Names with length, tokens, mask and the fewest characters any match shares."""
    n = F.length("name")
    need = F.greatest(F.ceil(F.lit(least) * n - EPS), F.lit(1)).cast("int")
    return names.withColumns({"length": n, "tokens": _tokens(F.col("name"))}).withColumns({"mask": _mask(F.col("tokens")), "need": need})


def _signatures(sized: DataFrame, block: Sequence[str], least: float, k: int) -> DataFrame:
    """One row per (name, signature).

    A match that needs k or more shared characters is found by k-sets of the
    prefixes; one that needs j < k, possible for short names only, by j-sets of
    the whole names; one with a long name by sets of two.
    """

    def prefixes(j: int) -> Column:
        return F.slice("tokens", F.lit(1), F.col("length") - F.greatest(F.col("need"), F.lit(j)) + j)

    none = F.array().cast("array<bigint>")
    long = F.col("length") > LONG
    near = F.col("length") >= LONG * least  # can match a long one
    shaped = sized.withColumns({"prefix": F.when(~long, prefixes(k)), "pairs": F.when(near, prefixes(2))})
    sets = [F.when(long, none).otherwise(_sets_of("prefix", k))] if k > 2 else [_sets_of("prefix", k)]
    if k > 2:
        sets.append(F.when(near, _sets_of("pairs", 2)).otherwise(none))
    else:
        shaped = shaped.withColumn("prefix", prefixes(2))
    sets += [F.when(F.col("need") <= j, _sets_of("tokens", j)).otherwise(none) for j in range(1, k)]
    return shaped.select(*block, *CARRIED, F.explode(F.array_distinct(F.concat(*sets))).alias("sig"))


def _band(n: Column) -> tuple[Column, Column]:
    """First and last length of the band of a length: each length below 32 is one, longer ones share eight bands up to the double."""
    power = F.call_function("shiftleft", F.lit(1), F.length(F.bin(n.cast("long"))) - 1)
    step = F.greatest(F.floor(power / 8), F.lit(1)).cast("int")
    first = F.when(n < 32, n).otherwise(power + F.floor((n - power) / step).cast("int") * step).cast("int")
    return first, F.when(n < 32, n).otherwise(first + step - 1).cast("int")


def _banded(names: DataFrame, low: Column, e: Edits) -> DataFrame:
    """The band of a length with its edits (``most``), piece length (``size``) and block width."""
    first, last = _band(low)
    names = names.withColumns({"band": first, "last": last})
    most = F.floor(F.lit(e.short) * F.col("last") + F.lit(e.long) * F.floor(F.lit(e.reach) * F.col("last") + EPS) + EPS)
    names = names.withColumn("most", most.cast("int"))
    return names.withColumns({"size": F.floor(F.col("band") / (F.col("most") + 1)).cast("int"), "width": 2 * F.col("most") + 1})


def _pieces(sized: DataFrame, block: Sequence[str], e: Edits) -> DataFrame:
    """One row per name and piece of it, as the shorter name of a pair: the first ``most`` + 1 pieces of its band's size."""
    banded = _banded(sized, F.length("name"), e)
    place = F.transform(
        F.sequence(F.lit(0), F.col("most")),
        lambda i: F.xxhash64("band", F.floor(i * F.col("size") / F.col("width")), F.substring("name", i * F.col("size") + 1, F.col("size"))),
    )
    return banded.select(*block, *CARRIED, F.explode(F.array_distinct(place)).alias("sig"))


def _probes(sized: DataFrame, block: Sequence[str], e: Edits) -> DataFrame:
    """One row per name, band it can be the longer name for, and place a piece can stand in it."""
    least = F.greatest(F.ceil(F.length("name") / F.lit(e.reach) - EPS), F.lit(1)).cast("int")
    bands = F.array_distinct(F.transform(F.sequence(least, F.length("name")), lambda n: _band(n)[0]))
    banded = _banded(sized.withColumn("low", F.explode(bands)), F.col("low"), e)

    def key(at: Column, piece: Column) -> Column:
        return F.xxhash64("band", F.floor(at / F.col("width")), piece)

    def places(p: Column) -> Column:
        piece = F.substring("name", p + 1, F.col("size"))
        return F.array(key(p - F.col("most"), piece), key(p + F.col("most"), piece))

    every = F.transform(F.sequence(F.lit(0), F.length("name") - F.col("size")), places)
    return banded.select(*block, *CARRIED, F.explode(F.array_distinct(F.flatten(every))).alias("sig"))


def candidate_pairs(
    names: DataFrame, measure: str, threshold: float, block: Sequence[str] = (), hot_rows: int = 20_000
) -> DataFrame:
    """Pairs that meet under a signature and pass the native checks (``a_`` and ``b_`` columns): every match is among them, once.

    The distinct names are written once to the shared folder, because several branches
    read them. A signature shared by more than ``hot_rows`` names is cut into slices that
    are joined in separate tasks. Signature rows are narrow: text and characters of the
    names are joined to the pairs that are left, so a long name may have many rows.
    """
    m = MEASURES[measure]
    least = m.least(threshold)
    if least <= 0:
        raise ValueError(f"threshold {threshold} is too low for an exact filter on {measure}")
    spark = names.sparkSession
    folder = work_dir(spark, "names")
    # A fixed number of tasks: the input of the join is small next to its work, so it must not be merged into few.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    k = _set_size(least)
    # rows are numbered as they are written; what is read again keeps its numbers
    _sized(names.repartition(tasks, "name"), least).withColumn("row", F.monotonically_increasing_id()).write.parquet(folder)
    sized = spark.read.parquet(folder)
    edits = m.edits(threshold)
    by_pieces = edits is not None and edits.selective()
    if by_pieces:
        ours, theirs = _pieces(sized, block, edits), _probes(sized, block, edits)
    else:
        ours = theirs = _signatures(sized, block, least, k)
    key = [*block, "sig"]
    hot = (
        ours.groupBy(*key)
        .agg(F.count("*").alias("_n"))
        .filter(F.col("_n") > hot_rows)
        .select(*key, F.ceil(F.col("_n") / F.lit(hot_rows)).cast("int").alias("_slices"))
    )

    def sliced(sigs: DataFrame) -> DataFrame:
        return sigs.join(hot, key, "left").withColumn("_slices", F.coalesce("_slices", F.lit(1)))

    left = sliced(ours).select(
        *key,
        F.pmod(F.xxhash64("row"), F.col("_slices")).cast("int").alias("_slice"),
        *[F.col(c).alias(f"a_{c}") for c in CARRIED],
    )
    right = sliced(theirs).select(
        *key,
        F.explode(F.sequence(F.lit(0), F.col("_slices") - 1)).alias("_slice"),
        *[F.col(c).alias(f"b_{c}") for c in CARRIED],
    )
    a, b = F.col("a_length"), F.col("b_length")
    need = m.overlap(a, b, threshold) - EPS

    def lacking(one: str, other: str) -> Column:
        """Tokens of one name that the other certainly lacks."""
        return F.bit_count(F.col(f"{one}_mask").bitwiseAND(F.bitwise_not(F.col(f"{other}_mask"))))

    # a merge join: the size of exploded signatures is not known well enough to broadcast them
    met = left.repartition(tasks, *key, "_slice").join(right.hint("merge"), [*key, "_slice"])
    if by_pieces:  # the shorter name was cut; of equally long ones either, once
        met = met.filter((a < b) | ((a == b) & (F.col("a_row") < F.col("b_row")))).filter(b <= F.lit(edits.reach) * a + EPS)
    else:
        met = met.filter(F.col("a_row") < F.col("b_row"))
    # a pair may meet under several signatures
    met = met.filter(a - lacking("a", "b") >= need).filter(b - lacking("b", "a") >= need)
    met = met.select("a_row", "b_row").distinct()
    for side in ("a", "b"):
        own = sized.select(*(block if side == "a" else ()), *[F.col(c).alias(f"{side}_{c}") for c in ("row", "id", "name", "members", "length", "tokens")])
        met = met.join(own, f"{side}_row")
    return met.filter(F.size(F.array_intersect("a_tokens", "b_tokens")) >= need)


def similar_pairs(
    names: DataFrame, measure: str, threshold: float, block: Sequence[str] = (), hot_rows: int = 20_000
) -> DataFrame:
    """All pairs of distinct names (within a block) whose score reaches the threshold.

    Result: block columns, left_id < right_id, both names, both member counts and
    score (see ``candidate_pairs`` for how pairs are found).
    """
    m = MEASURES[measure]
    candidates = candidate_pairs(names, measure, threshold, block, hot_rows)
    # The smaller id comes first, also for scoring: some measures depend on the order in rare cases.
    swap = F.col("a_id") > F.col("b_id")

    def side(c: str, is_left: bool) -> Column:
        one, other = ("b", "a") if is_left else ("a", "b")
        return F.when(swap, F.col(f"{one}_{c}")).otherwise(F.col(f"{other}_{c}"))

    pairs = candidates.select(
        *block,
        *[side(c, True).alias(f"left_{c}") for c in ("id", "name", "members")],
        *[side(c, False).alias(f"right_{c}") for c in ("id", "name", "members")],
    )
    if m.signals:
        scored = pairs.withColumn("_signals", m.signals("left_name", "right_name")).select("*", "_signals.*").drop("_signals")
    else:
        scored = pairs.withColumn("score", m.score(F.col("left_name"), F.col("right_name")))
    return scored.filter(F.col("score") >= threshold)


def comparison_counts(names: DataFrame, block: Sequence[str]) -> DataFrame:
    """Pairs an unfiltered comparison would make per block, from counts alone."""
    n = F.col("names")
    return (
        names.groupBy(*block)
        .agg(F.count("*").alias("names"))
        .withColumn("comparisons", (n * (n - 1) / 2).cast("long"))
    )


def duplicate_members(df: DataFrame, id_col: str, composite: Sequence[Column]) -> DataFrame:
    """Every row whose normalized composite occurs more than once, with its group.

    Groups are counted first and joined back, so no group is ever gathered in
    one task, and a hot group crosses the join as rows AQE can split.
    """
    key = F.concat_ws("|", *composite)
    keyed = df.withColumn("composite", key)
    groups = (
        keyed.groupBy("composite")
        .agg(F.count("*").alias("group_size"), F.min(id_col).alias("first_id"))
        .filter("group_size > 1")
    )
    return keyed.join(groups, "composite")


def duplicate_groups(df: DataFrame, id_col: str, composite: Sequence[Column]) -> DataFrame:
    """(composite, group_size, first_id, last_id) per group of exact duplicates."""
    return (
        df.select(F.concat_ws("|", *composite).alias("composite"), F.col(id_col).alias("_id"))
        .groupBy("composite")
        .agg(
            F.count("*").alias("group_size"),
            F.min("_id").alias("first_id"),
            F.max("_id").alias("last_id"),
        )
        .filter("group_size > 1")
    )


def review_candidates(
    pairs: DataFrame, auto: float, review: float, id_name: str, created_at: Column, created_by: str
) -> DataFrame:
    """Review-queue rows of scored pairs: label, OPEN status and a rationale document; signals that the pairs bring are not computed again."""
    kept = {"lev_ratio", "jaro_winkler"} <= set(pairs.columns)
    ratio, winkler = (F.col("lev_ratio"), F.col("jaro_winkler")) if kept else (indel_ratio("left_name", "right_name"), jaro_winkler("left_name", "right_name"))
    return pairs.filter(F.col("score") >= review).select(
        F.xxhash64("left_id", "right_id").alias("review_id"),
        F.col("left_id").alias(f"left_{id_name}"),
        F.col("right_id").alias(f"right_{id_name}"),
        F.col("score").alias("confidence"),
        score_band(F.col("score"), auto, review).alias("recommendation"),
        F.lit("OPEN").alias("status"),
        F.to_json(
            F.struct(
                F.col("left_name").alias("a_name"),
                F.col("right_name").alias("b_name"),
                ratio.alias("lev_ratio"),
                winkler.alias("jaro_winkler"),
            )
        ).alias("rationale"),
        created_at.alias("created_at"),
        F.lit(created_by).alias("created_by"),
    )


def same_name_pairs(df: DataFrame, id_col: str, name: Column, block: Sequence[str] = ()) -> DataFrame:
    """(first_id, other_id) for rows that share a normalized name: n - 1 rows per group, all naming its smallest id."""
    keyed = df.select(*block, F.col(id_col).alias("other_id"), name.alias("name")).filter(F.col("name") != "")
    first = keyed.groupBy(*block, "name").agg(F.min("other_id").alias("first_id"), F.count("*").alias("n")).filter("n > 1")
    return keyed.join(first, [*block, "name"]).filter("other_id <> first_id").select("first_id", "other_id", "name")


def scored_pairs(df: DataFrame, id_col: str, name: Column, review: float, block: Sequence[str] = ()) -> DataFrame:
    """All that a queue needs to merge duplicates of every row: equal names with score 1, and similar names.

    Rows of an equal name are each paired with the smallest id of that name, which
    also stands for them in the pairs of similar names.
    """
    equal = same_name_pairs(df, id_col, name, block).select(
        F.col("first_id").alias("left_id"), F.col("other_id").alias("right_id"), F.col("name").alias("left_name"),
        F.col("name").alias("right_name"), *[F.lit(1.0).alias(c) for c in ("lev_ratio", "jaro_winkler", "score")],
    )
    similar = similar_pairs(distinct_names(df, id_col, name, block), "blended", review, block)
    return similar.select(*equal.columns).unionByName(equal)
