"""Tab-separated text export with bulk-load conventions: ``\\N`` for NULL,
tab and newline inside values replaced by a space, timestamps as
``yyyy-MM-dd HH:mm:ss``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from eventide.config import COPY_NULL_TOKEN as NULL_TOKEN, COPY_TS_FORMAT as TS_FORMAT


def field_text(c: Column, dtype: str) -> Column:
    if dtype.startswith("timestamp"):
        return F.date_format(c, TS_FORMAT)
    return F.translate(c.cast("string"), "\t\n", "  ")


def copy_line(df: DataFrame, cols: Sequence[str]) -> Column:
    types = dict(df.dtypes)
    return F.concat_ws("\t", *[F.coalesce(field_text(F.col(c), types[c]), F.lit(NULL_TOKEN))
                               for c in cols])


def to_copy_text(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(copy_line(df, cols).alias("line"))


def write_copy_text(df: DataFrame, cols: Sequence[str], path: str, mode: str = "append") -> None:
    """Write lines as plain text; no quoting or escaping is added."""
    to_copy_text(df, cols).write.mode(mode).text(path)
