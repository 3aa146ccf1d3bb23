"""Text helpers for labels and report cells."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_columns(df: DataFrame, column: str, sep: str, outputs: list[str]) -> DataFrame:
    """Split at a literal separator into fixed columns; missing parts are null."""
    parts = F.split(F.col(column), re.escape(sep))
    return df.withColumns({name: F.get(parts, F.lit(i)) for i, name in enumerate(outputs)})


def strip(column: Column | str) -> Column:
    """Remove white space of any kind at both ends."""
    return F.regexp_replace(_col(column), r"^\s+|\s+$", "")


def replace_literal(column: Column | str, old: str, new: str) -> Column:
    return F.replace(_col(column), F.lit(old), F.lit(new))


def thousands(column: Column | str, sep: str = ".") -> Column:
    """1234567 as 1.234.567."""
    return F.translate(F.format_number(_col(column), 0), ",", sep)


def percent_text(column: Column | str, decimals: int = 2) -> Column:
    """12.5 as ``12,50 %``."""
    shown = F.format_string(f"%.{decimals}f %%", _col(column).cast("double"))
    return F.replace(shown, F.lit("."), F.lit(","))


def count_pair(first: Column, second: Column) -> Column:
    """``a / b`` with absent counts shown as 0."""
    zero = F.lit(0)
    return F.concat_ws(
        " / ", F.coalesce(first, zero).cast("string"), F.coalesce(second, zero).cast("string")
    )


def has_prefix(column: Column | str, prefix: str) -> Column:
    return _col(column).startswith(prefix)


def metric_label(name: Column | str, metric: str, value: Column | str, decimals: int = 3) -> Column:
    """``name (METRIC=0.123)``."""
    return F.format_string(f"%s ({metric}=%.{decimals}f)", _col(name), _col(value).cast("double"))
