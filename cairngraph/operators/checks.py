"""Constraint checks and column defaults."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairngraph.schemas import COGNITIVE_STATUSES


def pk_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def orphans(child: DataFrame, parent: DataFrame, fk: dict[str, str]) -> DataFrame:
    """Child rows whose reference is complete but leads nowhere. `fk`: child column -> parent column."""
    known = parent.select(*[F.col(there).alias(here) for here, there in fk.items()])
    return child.dropna(subset=list(fk)).join(known, list(fk), "left_anti").select(*child.columns)


def enum_violations(df: DataFrame, column: str, values: Sequence[str] = COGNITIVE_STATUSES) -> DataFrame:
    """Rows with a value outside the list; null passes."""
    return df.filter(~F.col(column).isin(*values))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, nulls) from one pass over the table."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], list(columns), "column_name", "nulls")


def fill_defaults(df: DataFrame, defaults: dict[str, tuple[str, object]]) -> DataFrame:
    """Adds missing columns with their default; a null in an existing column stays null."""
    missing = {
        name: F.lit(value).cast(kind)
        for name, (kind, value) in defaults.items()
        if name not in df.columns
    }
    return df.withColumns(missing)
