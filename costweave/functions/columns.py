"""Scalar helpers: cleaning, safe conversion, ratios and evidence strings."""

from __future__ import annotations

import re
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costweave.schemas import MONEY, TOTAL

ColumnLike = Column | str


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c: ColumnLike, width: int) -> Column:
    """Trim both sides, keep at most ``width`` characters."""
    return F.substring(F.trim(col(c)), 1, width)


def safe_cast(c: ColumnLike, kind: T.DataType | str) -> Column:
    """NULL where the text does not convert."""
    return col(c).try_cast(kind)


def blank_to_null(c: ColumnLike) -> Column:
    return F.nullif(col(c), F.lit(""))


def first_of(*choices: ColumnLike) -> Column:
    """First non-null choice; the last one is usually a literal default."""
    return F.coalesce(*[col(c) for c in choices])


def safe_ratio(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """NULL when the denominator is zero or missing."""
    return F.when(col(denominator) != 0, col(numerator) / col(denominator))


def describe(**values: ColumnLike) -> Column:
    """``a=1; b=2`` with missing values left blank."""
    parts = []
    for i, (name, value) in enumerate(values.items()):
        parts += [F.lit(f"{'; ' if i else ''}{name}="), F.coalesce(col(value).cast("string"), F.lit(""))]
    return F.concat(*parts)


def zero_if_null(c: ColumnLike) -> Column:
    return F.coalesce(col(c), F.lit(0).cast(MONEY))


def total_when(condition: Column, amount: ColumnLike) -> Column:
    """Sum of ``amount`` over rows that meet ``condition``; 0 when none does."""
    return F.coalesce(F.sum(F.when(condition, col(amount))), F.lit(0)).cast(TOTAL)


def count_when(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def quoted(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def stacked(rows: list[list[str]], names: list[str]) -> Column:
    """Rows of SQL expressions unpivoted into the named columns."""
    values = ", ".join(v for row in rows for v in row)
    return F.expr(f"stack({len(rows)}, {values}) AS ({', '.join(names)})")


def side_by_side(*totals: DataFrame) -> DataFrame:
    """One-row frames with different columns as a single row."""
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), totals)
    return union.agg(*[F.max(c).alias(c) for c in union.columns])


def month_of(c: ColumnLike) -> Column:
    return F.trunc(col(c), "MM")


def inline(spark, rows: list[tuple], ddl: str) -> DataFrame:
    """A few literal rows, such as a rule catalogue, as a JVM-side relation."""
    names = [part.split()[0] for part in re.split(r",\s*(?![0-9])", ddl)]
    table = pa.table({n: pa.array([row[i] for row in rows]) for i, n in enumerate(names)})
    return spark.createDataFrame(table, ddl)
