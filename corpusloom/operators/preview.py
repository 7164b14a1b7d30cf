"""The first rows of a table, as a reader would want to see them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_rows(df: DataFrame, n: int, order_by: str, width: int | None = None) -> DataFrame:
    """``n`` rows by ``order_by``; strings longer than ``width`` end in '...'."""
    top = df.orderBy(order_by).limit(n)
    if width is None:
        return top
    cut = {
        name: F.when(
            F.length(name) > width,
            F.concat(F.substring(name, 1, width - 3), F.lit("...")),
        ).otherwise(F.col(name))
        for name, kind in top.dtypes
        if kind == "string"
    }
    return top.withColumns(cut)
