"""A lookup join that stands up to keys with a large share of the rows."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 64 << 20


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    fact_rows: str,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Inner join of ``facts`` to ``lookup``, which has one row per key.

    ``lookup[fact_rows]`` is the number of facts of that key. A lookup of
    measured small size is broadcast. Of a larger one only the frequent keys
    are: fewer than ``n`` keys can each hold more than 1/n of the facts. The
    rest is joined by shuffle, where no key is larger than that share.

    ``lookup`` is read several times; pass a written table.
    """
    rows, size, total = _measure(lookup, keys, fact_rows)
    if rows <= max_rows and size <= max_bytes:
        return facts.join(F.broadcast(lookup), keys)

    limit = max_rows
    while True:
        threshold = total // limit
        frequent = lookup.filter(F.col(fact_rows) > threshold)
        if _measure(frequent, keys, fact_rows)[1] <= max_bytes or limit == 1:
            break
        limit = max(limit // 2, 1)
    rare = lookup.filter(F.col(fact_rows) <= threshold)
    few = F.broadcast(frequent)
    of_frequent = facts.join(few, keys)
    of_rare = facts.join(F.broadcast(frequent.select(keys)), keys, "left_anti").join(rare, keys)
    return of_frequent.unionByName(of_rare)


def _measure(lookup: DataFrame, keys: list[str], fact_rows: str) -> tuple[int, int, int]:
    """Rows, bytes (strings as stored, 8 for any other value) and facts."""
    kinds = dict(lookup.dtypes)
    width = reduce(
        add,
        [
            F.octet_length(name) if kinds[name] == "string" else F.lit(8)
            for name in lookup.columns
        ],
    )
    row = lookup.agg(
        F.count("*"),
        F.coalesce(F.sum(width), F.lit(0)),
        F.coalesce(F.sum(fact_rows), F.lit(0)),
    ).first()
    return row[0], row[1], row[2]
