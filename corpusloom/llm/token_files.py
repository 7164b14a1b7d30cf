"""Token ids in Arrow files of equal-length sequences.

Each file covers a range of documents in ascending identifier order. Its batches have
two fixed-size-list columns, ``ids`` and ``mask``; ids are as wide as the vocabulary
needs, a mask is the bits of whole bytes, lowest first, 1 for an id and 0 for padding.
Sequences run on across documents, only the last of a file is padded. Lists of one size put sequence i at a fixed
place, so that a memory-mapped file hands out both without copying. A second, small file holds the documents' places.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
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
from corpusloom.workspace import materialize, new_path

END_ID = 0
LENGTH = 1024
SEQUENCES_PER_BATCH = 1024

MANIFEST = (
    "part INT, path STRING, index_path STRING, n_docs BIGINT, n_ids BIGINT, n_sequences BIGINT"
)


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


class SequenceWriter:
    """Writes ids as they come; at most one batch is held."""

    def __init__(self, stream, width: str, length: int) -> None:
        import pyarrow as pa

        self.pa, self.width, self.length = pa, width, length
        self.schema = pa.schema(
            {
                "ids": pa.list_(pa.from_numpy_dtype(np.dtype(width)), length),
                "mask": pa.list_(pa.uint8(), -(-length // 8)),
            }
        )
        self.writer = pa.ipc.new_file(stream, self.schema)
        self.held: list[np.ndarray] = []
        self.n_held = self.n_ids = self.n_sequences = 0

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids.astype(self.width))
        self.n_held += len(ids)
        self.n_ids += len(ids)
        full = self.length * SEQUENCES_PER_BATCH
        if self.n_held >= full:
            flat = np.concatenate(self.held)
            ready = self.n_held // full * full
            for i in range(0, ready, full):
                self._batch(flat[i : i + full], full)
            self.held, self.n_held = [flat[ready:]], self.n_held - ready

    def _batch(self, flat: np.ndarray, n_real: int) -> None:
        pa = self.pa
        real = (np.arange(len(flat)) < n_real).reshape(-1, self.length)
        mask = np.packbits(real, axis=1, bitorder="little")
        lists = [
            pa.FixedSizeListArray.from_arrays(pa.array(values), size)
            for values, size in ((flat, self.length), (mask.ravel(), mask.shape[1]))
        ]
        self.writer.write_batch(pa.record_batch(lists, schema=self.schema))
        self.n_sequences += len(flat) // self.length

    def close(self) -> None:
        if self.n_held:
            flat = np.concatenate(self.held)
            padding = -len(flat) % self.length
            self._batch(np.concatenate([flat, np.zeros(padding, self.width)]), len(flat))
        self.writer.close()


class SequenceReader:
    """Random access to the sequences and ids of one file; a local one is mapped."""

    def __init__(self, uri: str) -> None:
        import pyarrow as pa

        store, path = _open(uri)
        local = store.type_name == "local"
        self.file = pa.ipc.open_file(pa.memory_map(path) if local else store.open_input_file(path))
        self.length = self.file.schema.field("ids").type.list_size
        self.mask_size = self.file.schema.field("mask").type.list_size
        self.held: tuple[int, np.ndarray, np.ndarray] | None = None

    def _batch(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        if self.held is None or self.held[0] != i:
            batch = self.file.get_batch(i)
            ids = batch.column("ids").flatten().to_numpy(zero_copy_only=True)
            mask = batch.column("mask").flatten().to_numpy(zero_copy_only=True)
            self.held = (i, ids, mask)
        return self.held[1], self.held[2]

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of sequence ``i``, views of the file; :func:`mask_values` spells the
        bits of the mask out."""
        ids, mask = self._batch(i // SEQUENCES_PER_BATCH)
        row = i % SEQUENCES_PER_BATCH
        own = mask[row * self.mask_size : (row + 1) * self.mask_size]
        return ids[row * self.length : (row + 1) * self.length], own

    def ids(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from place ``start`` of the file, wherever sequences end."""
        size = self.length * SEQUENCES_PER_BATCH
        found = []
        while n > 0:
            ids, _ = self._batch(start // size)
            got = ids[start % size : start % size + n]
            found.append(got)
            start, n = start + len(got), n - len(got)
        return found[0] if len(found) == 1 else np.concatenate(found or [np.zeros(0, "u2")])


def mask_values(mask: np.ndarray, length: int) -> np.ndarray:
    """One boolean for each id of a sequence, from the bits of its mask."""
    return np.unpackbits(mask, count=length, bitorder="little").view("bool")


def _write_parts(folder: str, vocabulary: str, length: int, end_id: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow as pa

        batches = (b for b in batches if len(b))
        first = next(batches, None)
        if first is None:
            return
        bpe = encoder(vocabulary)
        width = "uint16" if bpe.vocabulary_size <= 1 << 16 else "uint32"
        task = TaskContext.get()
        part, attempt = task.partitionId(), task.taskAttemptId()
        store, root = _open(folder)
        store.create_dir(root, recursive=True)
        names = [f"{kind}-{part:06d}.arrow" for kind in ("tokens", "documents")]
        # another attempt of this task may be at work; the whole file gets its name at the end
        drafts = [f"{root}/.{name}.{attempt}" for name in names]
        ids_of, lengths = [], []
        with store.open_output_stream(drafts[0]) as stream:
            writer = SequenceWriter(stream, width, length)
            end = np.array([end_id], "<u4").tobytes()
            while first is not None:
                found = bpe.encode_all(first["text"])
                for doc_id, ids in zip(first["doc_id"], found, strict=True):
                    ids = np.frombuffer(ids + end, "<u4")
                    writer.add(ids)
                    ids_of.append(None if pd.isna(doc_id) else int(doc_id))
                    lengths.append(len(ids))
                first = next(batches, None)
            writer.close()
        counts = np.array(lengths, "int64")
        places = pa.table(
            {
                "doc_id": pa.array(ids_of, pa.int64()),
                "start": np.cumsum(counts) - counts,
                "n_tokens": counts,
            }
        )
        with store.open_output_stream(drafts[1]) as stream:
            with pa.ipc.new_file(stream, places.schema) as out:
                out.write_table(places)
        for draft, name in zip(drafts, names, strict=True):
            store.move(draft, f"{root}/{name}")
        paths = [f"{folder}/{name}" for name in names]
        row = (part, *paths, len(counts), writer.n_ids, writer.n_sequences)
        yield pd.DataFrame([row], columns=[c.split()[0] for c in MANIFEST.split(", ")])

    return run


def write_token_files(
    docs: DataFrame,
    folder: str | None = None,
    vocabulary: str | None = None,
    length: int = LENGTH,
    end_id: int = END_ID,
) -> DataFrame:
    """Write the files and return their manifest, one row for each file that has
    documents: ``(part, path, index_path, n_docs, n_ids, n_sequences)``.

    Documents come in ascending order of ``doc_id``, rows without one first, rows that
    repeat one in the order of their texts; each is written, with ``end_id`` after it. A
    null text is empty, so the document is its end id alone. An empty table writes no
    file. ``folder`` must be one that all executors reach, by default one in
    ``spark.checkpoint.dir``.
    """
    spark = docs.sparkSession
    ship_package(spark)
    folder = folder or new_path(spark, "token-files")
    vocabulary = vocabulary or default_vocabulary()
    dealt = id_and_text(docs).repartitionByRange(shuffle_partitions(spark), "doc_id")
    ordered = dealt.sortWithinPartitions("doc_id", "text")
    write = _write_parts(folder, vocabulary, length, end_id)
    return materialize(exact_ids(ordered).mapInPandas(write, MANIFEST), "token-manifest")


def read_documents(manifest: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of each document, read back from the
    files; ``start`` counts the ids of all documents before it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow as pa

        for batch in batches:
            for part in batch.itertuples():
                reader = SequenceReader(part.path)
                store, path = _open(part.index_path)
                table = pa.ipc.open_file(store.open_input_file(path)).read_all()
                places = table.select(["start", "n_tokens"]).to_pandas()
                sums = [
                    zlib.crc32(reader.ids(start, n).astype("<u4").tobytes())
                    for start, n in zip(places["start"], places["n_tokens"], strict=True)
                ]
                yield pd.DataFrame(
                    {
                        "doc_id": whole_ids(table.column("doc_id").to_pylist()),
                        "start": places["start"] + part.base,
                        "n_tokens": places["n_tokens"],
                        "ids_crc32": np.array(sums, "int64"),
                    }
                )

    # one row for each file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    files = max(placed.count(), 1)
    schema = "doc_id BIGINT, start BIGINT, n_tokens BIGINT, ids_crc32 BIGINT"
    return placed.repartition(files, "part").mapInPandas(run, schema)


@dataclass(frozen=True)
class TokenFiles:
    """Files of a corpus and how to read them again."""

    manifest: DataFrame

    def documents(self) -> DataFrame:
        return read_documents(self.manifest)


def token_files(docs: DataFrame, **options) -> TokenFiles:
    return TokenFiles(write_token_files(docs, **options))
