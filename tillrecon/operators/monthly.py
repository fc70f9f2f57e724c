"""Monthly totals: periods, modes, designations, pivots and their independent control."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillrecon import fixed
from tillrecon.functions.money import MONEY_TYPE, as_zero
from tillrecon.functions.periods import period_of
from tillrecon.functions.text import fail_unless, holds

SUM_TYPE = "decimal(28,2)"

REVENUE = ("total_ht", "total_vat20", "ttc")
PAYMENTS = ("ttc", "pay_card", "pay_cheque", "pay_cash")


def with_totals_and_period(
    tickets: DataFrame,
    nets=("ht1", "ht2", "ht3", "ht4", "ht_exempt"),
    vat: str = "vat1",
    date: str = "ticket_date",
) -> DataFrame:
    """Add total net amount (blanks left out), tax at the standard rate, year and period."""
    total = as_zero(F.col(nets[0]))
    for name in nets[1:]:
        total = total + as_zero(F.col(name))
    return tickets.withColumns(
        {
            "total_ht": total.cast(MONEY_TYPE),
            "total_vat20": as_zero(F.col(vat)),
            "year": F.year(date),
            "period": period_of(F.col(date)),
        }
    )


def monthly_totals(
    df: DataFrame, measures, by=(), date: str | None = None, sum_type: str = SUM_TYPE
) -> DataFrame:
    """Sum of each measure per ``by``, year and period.

    With ``date`` the rows are grouped by the first day of its month and the period is written out
    once per group. Sums are partial before the shuffle: what crosses the network is one row per
    task, group and month.
    """
    sums = [F.sum(m).cast(sum_type).alias(m) for m in measures]
    if date is None:
        return df.groupBy(*by, "year", "period").agg(*sums)
    grouped = df.groupBy(*by, F.trunc(date, "month").alias("_month")).agg(*sums)
    return grouped.select(
        *by, F.year("_month").alias("year"), period_of(F.col("_month")).alias("period"), *measures
    )


def canonical_designation(designation: Column, aliases=None) -> Column:
    """One name for designations the tills print in several ways."""
    found = designation
    for alias, name in (fixed.DESIGNATION_ALIASES if aliases is None else aliases).items():
        found = F.when(designation == alias, name).otherwise(found)
    return found


def for_natures(df: DataFrame, natures=fixed.NATURES, column: str = "designation") -> DataFrame:
    return df.filter(F.col(column).isin(*natures))


def for_mode(df: DataFrame, mode: str, column: str = "mode", on_missing_mode: str = "fail") -> DataFrame:
    """Rows of one mode. ``fail``: the job that reads them fails if there are none; ``empty``: it does not.

    The look whether there are any is a subquery of that job.
    """
    own = F.col(column) == mode
    rows = df.filter(own)
    if on_missing_mode == "fail":
        there = df.agg(holds(F.count_if(own) > 0, f"mode not in the data: {mode}").alias("there"))
        rows = rows.filter(there.scalar())
    return rows


def small_table(spark: SparkSession, rows, schema: str) -> DataFrame:
    """DataFrame of configuration rows; Spark knows their size and chooses the join by it."""
    return spark.createDataFrame(list(rows), schema)


def applicable_modes(
    requested: DataFrame, excluded=(), overrides=None, modes=fixed.MODES
) -> DataFrame:
    """Requested (mode, shop, year) without the excluded ones; ``resolved_mode`` after overrides.

    An unknown mode fails the job.
    """
    spark = requested.sparkSession
    known = F.col("mode").isin(*modes)
    message = F.concat(F.lit("unknown mode: "), F.coalesce("mode", F.lit("NULL")))
    checked = requested.withColumn("mode", fail_unless(known, F.col("mode"), message))
    keys = ["mode", "shop", "year"]
    left = checked.join(
        small_table(spark, excluded, "mode string, shop string, year int"), keys, "left_anti"
    )
    changed = small_table(
        spark,
        [(*key, mode) for key, mode in (overrides or {}).items()],
        "mode string, shop string, year int, _override string",
    )
    resolved = F.coalesce("_override", "mode").alias("resolved_mode")
    return left.join(changed, keys, "left").select(*requested.columns, resolved)


def retained_mode(df: DataFrame, mode_of_shop: dict, shop: str = "shop", mode: str = "mode") -> DataFrame:
    """Rows in the mode kept for their shop. A filter on literals, which reaches the scan."""
    kept = F.lit(False)
    for name, own in mode_of_shop.items():
        kept = kept | ((F.col(shop) == name) & (F.col(mode) == own))
    return df.filter(kept)


def safe_name(value: str) -> str:
    """Column name for a pivoted value: letters, digits and underscores."""
    return "".join(c if c.isalnum() else "_" for c in value)


def monthly_pivot(
    rows: DataFrame, column: str, values, measures, by=(), name=safe_name, sum_type=None
) -> DataFrame:
    """Per ``by``, year and period one column per value and measure: ``<value>_<measure>``.

    A single measure names its columns by the value alone. The values are given, so no job is
    needed to find them and the schema is fixed. Absent cells are NULL.
    """
    kinds = dict(sum_type or {})
    # Two-step aggregation: sums per value first, the spread over columns sees those sums only.
    sums = [F.sum(m).cast(kinds.get(m, SUM_TYPE)).alias(m) for m in measures]
    wide = rows.groupBy(*by, "year", "period").pivot(column, list(values)).agg(*sums)
    renamed = []
    for value in values:
        for measure in measures:
            if len(measures) == 1:
                renamed.append(F.col(f"`{value}`").alias(name(value)))
            else:
                renamed.append(F.col(f"`{value}_{measure}`").alias(f"{name(value)}_{measure}"))
    return wide.select(*by, "year", "period", *renamed)


def mode_totals(
    rows: DataFrame,
    mode: str | None,
    values,
    measures=("qty", "amount"),
    column: str = "designation",
    mode_column: str = "mode",
    by=(),
    on_missing_mode: str = "fail",
    sum_type=None,
) -> DataFrame:
    """Monthly totals of one mode, every listed value present, absent cells zero."""
    if mode is not None:
        rows = for_mode(rows, mode, mode_column, on_missing_mode)
    wide = monthly_pivot(rows, column, values, measures, by, sum_type=sum_type)
    keys = {*by, "year", "period"}
    return wide.select(
        *(
            c
            if c in keys
            else F.coalesce(F.col(c), F.lit(0).cast(wide.schema[c].dataType)).alias(c)
            for c in wide.columns
        )
    )


def conditional_totals(
    rows: DataFrame,
    values,
    measures=("qty", "amount"),
    column: str = "designation",
    by=(),
    sum_type=None,
) -> DataFrame:
    """What :func:`mode_totals` gives, by conditional sums in one shuffle; the control of the pivot."""
    kinds = dict(sum_type or {})
    sums = []
    for value in values:
        for measure in measures:
            kind = kinds.get(measure, SUM_TYPE)
            own = F.sum(F.when(F.col(column) == value, F.col(measure))).cast(kind)
            alias = safe_name(value) if len(measures) == 1 else f"{safe_name(value)}_{measure}"
            sums.append(F.coalesce(own, F.lit(0).cast(kind)).alias(alias))
    return rows.filter(F.col(column).isin(*values)).groupBy(*by, "year", "period").agg(*sums)


def occurrence_map(rows: DataFrame, by, columns, alias: str = "counts") -> DataFrame:
    """Row counts per ``by`` as a map from the joined value of ``columns`` (for example file and mode).

    Two partial sums and no look for the values that occur: a new one is a new key, and the schema stays.
    """
    joined = F.concat_ws("_", *(F.col(c).cast("string") for c in columns))
    counted = rows.groupBy(*by, joined.alias("_key")).agg(F.count("*").alias("_n"))
    return counted.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("_key", "_n")))).alias(alias))


def as_columns(mapped: DataFrame, names=None, column: str = "counts", widest: int = 2000, name=safe_name) -> DataFrame:
    """A column per key of a map, NULL where a row lacks it.

    Without ``names`` a job looks for the keys that occur; more than ``widest`` of them are an error.
    """
    if names is None:
        keys = mapped.select(F.explode(F.map_keys(column)).alias("k")).distinct()
        names = sorted(r["k"] for r in keys.limit(widest + 1).collect())
        if len(names) > widest:
            raise ValueError(f"more than {widest} values to spread over columns")
    others = [c for c in mapped.columns if c != column]
    return mapped.select(*others, *(F.col(column)[v].alias(name(v)) for v in names))


def occurrence_matrix(
    rows: DataFrame, by, columns, values=None, name=safe_name
) -> DataFrame:
    """Row counts per ``by`` spread over the joined value of ``columns``; see :func:`occurrence_map`."""
    return as_columns(occurrence_map(rows, by, columns), values, name=name)
