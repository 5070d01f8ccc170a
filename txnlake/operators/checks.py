"""Data checks as violation frames (empty frame = check passes).

Each check is a filter or a grouped count, so it runs distributed and the
violating rows can be written as a table (stored failures).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def violations_unique(df: DataFrame, cols: Sequence[str] | str) -> DataFrame:
    """Key values that occur more than once, with their count (NULL keys skipped)."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    keyed = df
    for c in cols:
        keyed = keyed.filter(F.col(c).isNotNull())
    return (
        keyed.groupBy(*cols)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def violations_not_null(df: DataFrame, cols: Sequence[str] | str) -> DataFrame:
    """Rows where any of ``cols`` is NULL."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    cond = None
    for c in cols:
        cond = F.col(c).isNull() if cond is None else cond | F.col(c).isNull()
    return df.filter(cond)


def violations_accepted(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Rows whose value is outside ``values`` (NULL passes)."""
    return df.filter(F.col(col).isNotNull() & ~F.col(col).isin(*values))


def violations_range(
    df: DataFrame,
    col: str,
    lo: float | None = None,
    hi: float | None = None,
    inclusive: bool = True,
) -> DataFrame:
    """Rows outside [lo, hi] (or (lo, hi) when not inclusive); NULL passes."""
    c = F.col(col)
    ok = F.lit(True)
    if lo is not None:
        ok = ok & ((c >= lo) if inclusive else (c > lo))
    if hi is not None:
        ok = ok & ((c <= hi) if inclusive else (c < hi))
    return df.filter(c.isNotNull() & ~ok)


def at_least_one(df: DataFrame, col: str) -> DataFrame:
    """One row when ``col`` has no non-NULL value, else no row."""
    return (
        df.agg(F.count(F.col(col)).alias("n_non_null"))
        .filter(F.col("n_non_null") == 0)
    )


# --- all row rules of a layer in one pass ------------------------------------------


def not_null(col: str) -> Column:
    return F.col(col).isNull()


def not_accepted(col: str, values: Sequence) -> Column:
    """Outside ``values``; NULL passes."""
    return F.col(col).isNotNull() & ~F.col(col).isin(*values)


def outside(col: str, lo: float, hi: float, inclusive: bool = True) -> Column:
    """Outside [lo, hi], or (lo, hi) when not inclusive; NULL passes."""
    c = F.col(col)
    ok = ((c >= lo) & (c <= hi)) if inclusive else ((c > lo) & (c < hi))
    return c.isNotNull() & ~ok


def counters(rules: dict[str, Column]) -> list[Column]:
    """An aggregate for each rule: rows that break it."""
    return [F.count_if(F.coalesce(broken, F.lit(False))).alias(name) for name, broken in rules.items()]


def failed_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(check, row): a row of ``df``, as JSON text, for every rule that it breaks. Each
    row's rules are evaluated in one array, so all of them take one pass."""
    names = F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules.items()]))
    broken = df.select(F.struct("*").alias("r"), names.alias("names")).filter(F.size("names") > 0)
    return broken.select(F.explode("names").alias("check"), F.to_json("r").alias("row"))


def repeated(df: DataFrame, name: str, col: str) -> DataFrame:
    """(check, row) for every value of ``col`` that occurs more than once."""
    found = violations_unique(df.select(col), col)
    return found.select(F.lit(name).alias("check"), F.to_json(F.struct("*")).alias("row"))


def count_by_rule(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(check, n_failed) with a row for every rule, broken or not."""
    counted = df.agg(*counters(rules))
    pairs = F.array(*[
        F.struct(F.lit(name).alias("check"), F.col(name).alias("n_failed")) for name in rules
    ])
    return counted.select(F.inline(pairs))
