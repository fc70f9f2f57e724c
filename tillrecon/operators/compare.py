"""Reconciliation: source against source, shop against shop, own figures against declared ones.

Both sides are tagged and meet in one aggregation: however many rows a month has, what crosses the network
is one row per task, side, group and month.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from tillrecon.functions.money import strict_amount
from tillrecon.functions.periods import period_of
from tillrecon.functions.text import holds
from tillrecon.operators.checks import describe, require_columns

KEYS = ("year", "period")


def reconcile(
    left: DataFrame,
    right: DataFrame,
    gaps: Mapping[str, tuple[str, str] | None],
    missing: str,
    keys=KEYS,
    year: int | None = None,
    strict: bool = False,
    keep_measures: bool = False,
) -> DataFrame:
    """Left minus right for every period of either side, with ``status`` both/left_only/right_only.

    ``gaps`` maps the name of a gap to its left and right measure; ``None`` keeps the gap blank.
    ``missing`` says what a period without the other side means:
    ``zero`` – the absent side counts as zero; ``null`` – there is no gap to tell, it stays NULL.
    An absent measure of a present row is zero, or fails the job when ``strict``.
    ``year`` is applied to both sides first. A period has one row per side; a repeated one fails the job that
    reads it, whichever columns it asks for. Both sides are tagged and meet in one aggregation.
    """
    pairs = _pairs(gaps, missing)
    sides = []
    for df, index, tag in ((left, 0, "left"), (right, 1, "right")):
        measures = list(dict.fromkeys(pair[index] for pair in pairs.values()))
        require_columns(df, *keys, *measures)
        if year is not None:
            df = df.filter(F.col("year") == year)
        df = df.select(*keys, *measures)
        if strict:
            for m in measures:
                df = df.filter(holds(F.col(m).isNotNull(), f"amount {m} is missing"))
            df = df.withColumns({m: strict_amount(F.col(m), m) for m in measures})
        named = [F.col(m).alias(f"_{tag}_{m}") for m in measures]
        sides.append(df.select(*keys, F.lit(tag).alias("_side"), *named))
    # A side has no value in the other one's columns.
    tagged = sides[0].unionByName(sides[1], allowMissingColumns=True)
    return _gaps_of(tagged, gaps, pairs, missing, keys, keep_measures)


def reconcile_tagged(
    rows: DataFrame, gaps: Mapping[str, tuple[str, str] | None], missing: str, keys=KEYS, side: str = "_side"
) -> DataFrame:
    """:func:`reconcile` of rows that hold both sides; ``side`` says which: left or right."""
    pairs = _pairs(gaps, missing)
    own = lambda tag, m: F.when(F.col(side) == tag, F.col(m)).alias(f"_{tag}_{m}")
    columns = [own("left", m) for m in dict.fromkeys(p[0] for p in pairs.values())]
    columns += [own("right", m) for m in dict.fromkeys(p[1] for p in pairs.values())]
    return _gaps_of(rows.select(*keys, F.col(side).alias("_side"), *columns), gaps, pairs, missing, keys)


def reconcile_sums(
    left: DataFrame,
    right: DataFrame,
    gaps: Mapping[str, tuple[str, str] | None],
    missing: str,
    keys=KEYS,
    sum_type: str = "decimal(28,2)",
    strict: bool = False,
    keep_measures: bool = False,
    date: str | None = None,
) -> DataFrame:
    """:func:`reconcile` of the sums per period of rows of either side.

    Both sides are added up where they are read, and their partial sums meet in one shuffle. With ``date`` rows are
    grouped by the first day of its month, and ``year`` and ``period`` are written out once per group.
    """
    if date is not None:
        others = [k for k in keys if k not in KEYS]
        month = lambda df: df.withColumn("_month", F.trunc(date, "month"))
        found = reconcile_sums(
            month(left), month(right), gaps, missing, (*others, "_month"), sum_type, strict, keep_measures
        )
        dated = [F.year("_month").alias("year"), period_of(F.col("_month")).alias("period")]
        return found.select(*others, *dated, *(c for c in found.columns if c not in (*others, "_month")))
    pairs = _pairs(gaps, missing)
    sides = []
    for df, index, tag in ((left, 0, "left"), (right, 1, "right")):
        measures = list(dict.fromkeys(pair[index] for pair in pairs.values()))
        named = [F.col(m).alias(f"_{tag}_{m}") for m in measures]
        sides.append(df.select(*keys, F.lit(tag).alias("_side"), *named))
    tagged = sides[0].unionByName(sides[1], allowMissingColumns=True)
    return _gaps_of(tagged, gaps, pairs, missing, keys, keep_measures, sum_type, strict)


def _pairs(gaps, missing: str) -> dict[str, tuple[str, str]]:
    if missing not in ("zero", "null"):
        raise ValueError(f"missing must be 'zero' or 'null', not {missing!r}")
    return {name: pair for name, pair in gaps.items() if pair is not None}


def _gaps_of(
    tagged: DataFrame, gaps, pairs, missing: str, keys, keep_measures=False, sum_type=None, strict=False
) -> DataFrame:
    """Gaps from one aggregation of both sides' rows: keys, ``_side`` and a column per side and measure.

    Without ``sum_type`` a key has one row per side; a second one fails the job that reads it.
    """
    values = [c for c in tagged.columns if c not in (*keys, "_side")]
    picked = [(F.max(c) if sum_type is None else F.sum(c).cast(sum_type)).alias(c) for c in values]
    counts = [F.count_if(F.col("_side") == tag).alias(f"_n_{tag}") for tag in ("left", "right")]
    joined = tagged.groupBy(*keys).agg(*counts, *picked)
    if sum_type is None:
        shown = F.concat_ws(", ", *(F.col(k).cast("string") for k in keys))
        for tag in ("left", "right"):
            message = F.concat(F.lit(f"duplicate period in {tag}: "), shown)
            joined = joined.filter(holds(F.col(f"_n_{tag}") <= 1, message))
    if strict:
        for value in values:
            here = F.col("_n_left" if value.startswith("_left_") else "_n_right") > 0
            message = f"amount {value.split('_', 2)[2]} is missing"
            joined = joined.filter(holds(~here | F.col(value).isNotNull(), message))
    has_left, has_right = F.col("_n_left") > 0, F.col("_n_right") > 0
    both = has_left & has_right
    columns = []
    for name, pair in gaps.items():
        if pair is None:
            columns.append(F.lit(None).cast("bigint").alias(name))
            continue
        zero = F.lit(0)
        gap = F.coalesce(F.col(f"_left_{pair[0]}"), zero) - F.coalesce(F.col(f"_right_{pair[1]}"), zero)
        columns.append((gap if missing == "zero" else F.when(both, gap)).alias(name))
    if keep_measures:
        for name, pair in pairs.items():
            columns.append(F.col(f"_left_{pair[0]}").alias(f"{name}_left"))
            columns.append(F.col(f"_right_{pair[1]}").alias(f"{name}_right"))
    status = F.when(both, "both").when(has_left, "left_only").otherwise("right_only")
    return joined.select(*keys, *columns, status.alias("status"))


def missing_periods(reconciled: DataFrame, keys=KEYS) -> DataFrame:
    """Periods one side lacks: ``absent_from`` left or right."""
    absent = F.when(F.col("status") == "left_only", "right").otherwise("left")
    return reconciled.filter(F.col("status") != "both").select(*keys, absent.alias("absent_from"))


def consolidate(
    monthly: DataFrame,
    shops,
    measures,
    keys=KEYS,
    shop: str = "shop",
    strict: bool = True,
    keep_shops: bool = True,
) -> DataFrame:
    """Months of all shops side by side, and their total per measure.

    ``strict``: a period that a shop lacks, or has twice, fails the job. Otherwise the total of such
    a period is NULL; a missing shop is never filled in.
    """
    own = lambda s: F.col(shop) == s
    aggregates = []
    for s in shops:
        aggregates.append(F.count_if(own(s)).alias(f"_n_{s}"))
        for m in measures:
            aggregates.append(F.sum(F.when(own(s), F.col(m))).alias(f"{s}_{m}"))
    wide = monthly.filter(F.col(shop).isin(*shops)).groupBy(*keys).agg(*aggregates)
    complete = F.lit(True)
    for s in shops:
        complete = complete & (F.col(f"_n_{s}") == 1)
    where = F.concat_ws(", ", *(F.col(k).cast("string") for k in keys))
    message = F.concat(F.lit("period not in every shop exactly once: "), where)
    totals = []
    for m in measures:
        total = F.col(f"{shops[0]}_{m}")
        for s in shops[1:]:
            total = total + F.col(f"{s}_{m}")
        totals.append((total if strict else F.when(complete, total)).alias(f"total_{m}"))
    if strict:
        wide = wide.filter(holds(complete, message))
    by_shop = [f"{s}_{m}" for s in shops for m in measures] if keep_shops else []
    return wide.select(*keys, *by_shop, *totals)


def compare_declared(
    own: DataFrame, declared: DataFrame, gaps: Mapping[str, tuple[str, str]], keys=KEYS
) -> DataFrame:
    """Own months with the declared amounts beside them; no gap where nothing was declared."""
    names = list(dict.fromkeys(pair[1] for pair in gaps.values()))
    joined = own.join(declared.select(*keys, *names), list(keys), "left")
    return joined.withColumns(
        {
            gap: F.when(F.col(theirs).isNotNull(), F.col(ours) - F.col(theirs))
            for gap, (ours, theirs) in gaps.items()
        }
    )


def differing_totals(left: DataFrame, right: DataFrame, keys=KEYS) -> DataFrame:
    """Periods in which two sets of totals differ; an absent period counts as all zero."""
    measures = [c for c in left.columns if c not in keys]
    require_columns(right, *keys, *measures)
    tagged = [
        df.select(*keys, *(F.col(m).alias(f"_{tag}_{m}") for m in measures))
        for df, tag in ((left, "left"), (right, "right"))
    ]
    joined = tagged[0].join(tagged[1], list(keys), "full_outer")
    differs = F.lit(False)
    for m in measures:
        zero = F.lit(0)
        differs = differs | (
            F.coalesce(F.col(f"_left_{m}"), zero) != F.coalesce(F.col(f"_right_{m}"), zero)
        )
    return joined.filter(differs)


def assert_same_totals(left: DataFrame, right: DataFrame, keys=KEYS, what: str = "totals") -> DataFrame:
    """Fail now if the totals differ; returns the left ones."""
    found = describe(differing_totals(left, right, keys), *keys)
    if found:
        raise ValueError(f"{what} differ in {found}")
    return left
