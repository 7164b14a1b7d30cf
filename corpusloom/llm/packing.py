"""Packing of documents into windows by non-negative least squares.

Documents are cut into whole windows and one rest. Rests are counted by length in units
of a few tokens. All combinations of at most ``DEPTH`` lengths that fill a window are
enumerated, and least squares with repeat counts of at least 0 are solved against the
histogram. The counts are rounded down, and what they leave is packed greedily, the
longest first. The plan has no more entries than the histogram has lengths, times a
small number, however many documents there are; documents find their place in it by
their rank among those of equal length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.bpe import default_vocabulary, encoder
from corpusloom.llm.common import (
    exact_ids,
    id_and_text,
    ship_package,
    shuffle_partitions,
    whole_ids,
)
from corpusloom.workspace import materialize

WINDOW = 1024
END_ID = 0
UNIT = 4
DEPTH = 3

PIECES = (
    "doc_id BIGINT, start BIGINT, length BIGINT, ids_crc32 BIGINT, doc_tokens BIGINT, ids BINARY"
)


def cut(docs: DataFrame, vocabulary: str, window: int, end_id: int) -> DataFrame:
    """One row for each piece: whole windows of a document, then its rest."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = encoder(vocabulary)
        end = np.array([end_id], "<u4").tobytes()
        names = [c.split()[0] for c in PIECES.split(", ")]
        for batch in batches:
            rows = []
            found = bpe.encode_all(batch["text"])
            for doc_id, ids in zip(batch["doc_id"], found, strict=True):
                ids += end
                for start in range(0, len(ids), 4 * window):
                    piece = ids[start : start + 4 * window]
                    rows.append(
                        (doc_id, start // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4, piece)
                    )
                if len(rows) >= 2000:
                    yield _frame(rows, names)
                    rows = []
            yield _frame(rows, names)

    return exact_ids(id_and_text(docs)).mapInPandas(run, PIECES)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=names)
    return frame.assign(doc_id=whole_ids(frame["doc_id"]))


def combinations(units: int, depth: int) -> np.ndarray:
    """One column for each multiset of at most ``depth`` lengths adding up to
    ``units``; row u - 1 has how often length u is in it."""
    found: list[list[int]] = []

    def extend(taken: list[int], left: int, most: int) -> None:
        if left == 0:
            found.append(taken)
        elif len(taken) < depth:
            least = -(-left // (depth - len(taken)))
            for u in range(min(left, most), least - 1, -1):
                extend([*taken, u], left - u, u)

    extend([], units, units)
    table = np.zeros((units, len(found)))
    for column, lengths in enumerate(found):
        for u in lengths:
            table[u - 1, column] += 1
    return table


def non_negative_least_squares(table: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """x >= 0 with the least ``|table x - wanted|``, by active sets: the column with the
    steepest descent enters, columns that would become negative leave."""
    n = table.shape[1]
    x, active = np.zeros(n), np.zeros(n, bool)
    tolerance = 1e-9 * max(1.0, np.abs(wanted).max(initial=0))
    for _ in range(3 * table.shape[0]):
        slope = table.T @ (wanted - table @ x)
        slope[active] = -np.inf
        best = int(slope.argmax())
        if slope[best] <= tolerance:
            break
        active[best] = True
        while True:
            chosen = np.flatnonzero(active)
            solved = np.linalg.lstsq(table[:, chosen], wanted, rcond=None)[0]
            if solved.min() > 0:
                x[:] = 0
                x[chosen] = solved
                break
            old = x[chosen]
            falling = solved <= 0
            drop = old[falling] - solved[falling]
            step = np.min(old[falling] / np.where(drop > 0, drop, 1))
            x[chosen] = old + step * (solved - old)
            gone = falling & (x[chosen] <= tolerance)
            if not gone.any():
                gone = falling & (old == old[falling].min())
            x[chosen[gone]] = 0
            active[chosen[gone]] = False
            if not active.any():
                break
    return x


def plan(histogram: np.ndarray, depth: int = DEPTH) -> list[tuple[int, list[int]]]:
    """``(repeats, lengths in units)``; together exactly the histogram, whose entry
    u - 1 is the number of pieces of u units, the last one being a window's."""
    units = len(histogram)
    left = histogram.astype("int64").copy()
    made: list[tuple[int, list[int]]] = []

    def take(uses: np.ndarray, most: int) -> None:
        held = np.flatnonzero(uses)
        repeats = min(most, *(int(left[u] // uses[u]) for u in held))
        if repeats > 0:
            left[held] -= repeats * uses[held].astype("int64")
            lengths = [int(u) + 1 for u in held[::-1] for _ in range(int(uses[u]))]
            made.append((repeats, lengths))

    if left.sum():
        table = combinations(units, depth)
        scale = left.max()
        solved = non_negative_least_squares(table, left / scale) * scale
        for column in np.argsort(-solved, kind="stable"):
            if solved[column] < 1:
                break
            take(table[:, column], int(solved[column] + 1e-6))
    while left.any():
        uses, space = np.zeros(units, "int64"), units
        for u in range(units, 0, -1):
            n = min(int(left[u - 1]), space // u)
            uses[u - 1], space = n, space - n * u
        take(uses, int(left.max()))
    return made


@dataclass(frozen=True)
class Packed:
    """The written pieces and their places."""

    pieces: DataFrame
    window: int

    def places(self) -> DataFrame:
        """``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)``."""
        return self._placed().drop("ids", "bin", "rank", "slot")

    def sequences(self, pad_id: int = END_ID) -> DataFrame:
        """``(sequence_id, ids, mask)``: the padded sequences. A sequence has at most as
        many pieces as the window has tokens."""
        window = self.window
        schema = "sequence_id BIGINT, ids ARRAY<INT>, mask ARRAY<BOOLEAN>"

        def fill(key: tuple, held: pd.DataFrame) -> pd.DataFrame:
            ids = np.frombuffer(b"".join(held.sort_values("offset")["ids"]), "<u4")
            padded = np.full(window, pad_id, "int32")
            padded[: len(ids)] = ids
            row = (key[0], padded, np.arange(window) < len(ids))
            return pd.DataFrame([row], columns=["sequence_id", "ids", "mask"])

        held = self._placed().select("sequence_id", "offset", "ids")
        return held.groupBy("sequence_id").applyInPandas(fill, schema)

    def _placed(self) -> DataFrame:
        ranked = _ranked(self.pieces, self.window)
        counts = ranked.groupBy("bin").agg(F.count("*").alias("n")).collect()
        histogram = np.zeros(self.window // UNIT, "int64")
        for row in counts:
            histogram[row["bin"] - 1] = row["n"]
        entries, base, used = [], 0, np.zeros(len(histogram) + 1, "int64")
        for repeats, lengths in plan(histogram):
            for slot, u in enumerate(lengths):
                entries.append((u, int(used[u]), int(used[u] + repeats), base, slot))
                used[u] += repeats
            base += repeats
        spark = self.pieces.sparkSession
        schema = "bin INT, first BIGINT, beyond BIGINT, base BIGINT, slot INT"
        # as many rows as the plan has slots: a fixed bound
        slots = F.broadcast(spark.createDataFrame(entries, schema))
        inside = (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("beyond"))
        found = ranked.join(slots, "bin").filter(inside)
        found = found.withColumn("sequence_id", F.col("base") + F.col("rank") - F.col("first"))
        before = Window.partitionBy("sequence_id").orderBy("slot")
        offset = F.sum("length").over(before.rowsBetween(Window.unboundedPreceding, -1))
        found = found.withColumn("offset", F.coalesce(offset, F.lit(0)).cast("bigint"))
        return found.drop("first", "beyond", "base")


def _ranked(pieces: DataFrame, window: int) -> DataFrame:
    """Pieces with ``bin``, their length in units, and ``rank`` among the equal ones:
    numbered within blocks, the blocks counted on from each other."""
    blocks = shuffle_partitions(pieces.sparkSession)
    binned = pieces.withColumn("bin", F.ceil(F.col("length") / UNIT).cast("int")).withColumn(
        "block", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(blocks)).cast("int")
    )
    sizes = binned.groupBy("bin", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("bin").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("bin", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("bin", "block").orderBy("doc_id", "start", "ids_crc32")
    numbered = binned.withColumn("number", F.row_number().over(inside))
    ranked = numbered.join(bases, ["bin", "block"])
    rank = F.col("base") + F.col("number") - 1
    return ranked.withColumn("rank", rank).drop("block", "base", "number")


def pack(
    docs: DataFrame, vocabulary: str | None = None, window: int = WINDOW, end_id: int = END_ID
) -> Packed:
    """Cut and place all documents.

    A null text is empty: its document is the end id alone. Rows that repeat an
    identifier are packed one by one, a null identifier is kept. An empty table gives no
    pieces. ``window`` must be a multiple of ``UNIT``.
    """
    ship_package(docs.sparkSession)
    vocabulary = vocabulary or default_vocabulary()
    return Packed(materialize(cut(docs, vocabulary, window, end_id), "pieces"), window)
