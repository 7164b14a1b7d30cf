"""Bytes that repeat an earlier document, by suffix arrays over shared passages.

Of equal texts the one with the smallest identifier has every window first, so the others
are repeats from end to end, and only that one is compared with other texts.

Every window of 50 bytes has an anchor, the 20-byte string in it whose hash is least, so
equal windows have equal anchors. Anchors that occur in one document only are out; a
filter that grows with the texts up to a bound, built on the executors from sorted runs of
cut hashes, tells which may occur in more. For those, the text of the windows that share the anchor is the
context of the occurrence, 50 to 80 bytes. Equal contexts are one from there on, with
their smallest document; their bytes move only where an anchor has several.

Contexts with one anchor, if they are several, are sorted by suffix in two stages: only
suffixes smaller than their successors are compared, all others follow from these in one
scan over the buckets of first bytes. Neighbours whose common prefix covers a window are
copies, and the smallest document of each run of neighbours is the one that keeps it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import (
    exact_ids,
    id_and_text,
    join_by_share,
    ship_package,
    shuffle_partitions,
    whole_ids,
)
from corpusloom.llm.hashing import mixed, powers
from corpusloom.workspace import materialize

WINDOW = 50
GRAM = 20
# A filter has 2 to this power cells, up to the second if there is much to tell apart, and
# sets so many of them for a hash.
FILTER_BITS = 27
MOST_BITS = 30
CELLS = 3
PIECE_BITS = 6
# Anchors are told apart by so many bits where they are counted, in runs of so many.
CODE_BITS = 40
RUN = 4_000_000
# Rows of occurrences that a task hands over at once.
SLICE = 50_000
# Anchors with more contexts than this are compared window by window, by shuffle.
MANY = 5_000
CHUNK = 300_000
# Runs of removed bytes are broadcast up to this number, 16 bytes each; identifiers too.
MAX_BROADCAST = 2_000_000
# A run of removed bytes is one number: where it begins, and in so many low bits its end.
END_BITS = 32


def anchors(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each anchor of a text its hash and the first and last window it stands for."""
    n = len(raw) - WINDOW + 1
    if n < 1:
        return np.zeros(0, "i8"), np.zeros(0, "i8"), np.zeros(0, "i8")
    up, down = powers(len(raw))
    sums = np.zeros(len(raw) + 1, "u8")
    np.cumsum((raw.astype("u8") + np.uint64(1)) * up[: len(raw)], out=sums[1:])
    grams = mixed((sums[GRAM:] - sums[:-GRAM]) * down[: len(raw) - GRAM + 1])
    span = WINDOW - GRAM + 1
    # least of span neighbours by doubling; the leftmost wins, as equal ones do not move it
    best, least = np.arange(len(grams), dtype="i8"), grams
    width = 1
    while width < span:
        step = min(width, span - width)
        a, b = least[:-step], least[step:]
        best = np.where(b < a, best[step:], best[:-step])
        least = np.minimum(a, b)
        width += step
    # anchors move to the right only
    first = np.flatnonzero(np.append(True, best[1:] != best[:-1]))
    place, last = best[first], np.append(first[1:], n) - 1
    return grams[place].view("i8"), first, last


def _bytes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-8"), "u1")


def _codes(grams: np.ndarray) -> np.ndarray:
    return mixed(grams.view("u8")) >> np.uint64(64 - CODE_BITS)


def _bucket_bits(spark: SparkSession) -> int:
    """Buckets of codes: as many as a shuffle has partitions, 256 at least."""
    return min(max(8, (shuffle_partitions(spark) - 1).bit_length()), 20)


def _digests(rows: DataFrame) -> DataFrame:
    """``(doc_id, size, digest)`` of texts with a window."""
    text = F.col("text")
    size = F.octet_length(text).alias("size")
    held = rows.select("doc_id", size, F.unhex(F.sha2(text, 256)).alias("digest"))
    return materialize(held.filter(F.col("size") >= WINDOW), "digests")


def _copies(held: DataFrame) -> DataFrame:
    """``(doc_id, size)`` of rows whose whole text an earlier document has."""
    groups = held.groupBy("digest").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("n")
    )
    groups = materialize(groups.filter("first < last"), "groups")
    met = join_by_share(held, groups, ["digest"], "n", held.count())
    # rows that repeat an identifier may differ in text, so none of them stands for the others
    single = held.groupBy("doc_id").count().filter(F.col("count") == 1)
    later = met.filter(F.col("doc_id") > F.col("first")).join(single, "doc_id", "left_semi")
    return materialize(later.select("doc_id", "size"), "copies")


def _without(rows: DataFrame, copies: DataFrame) -> DataFrame:
    """``rows`` without the copies, or without a share of them if they are too many to
    broadcast; what is left of them is compared like any other text."""
    share = -(-copies.count() // MAX_BROADCAST)
    ids = copies.select("doc_id")
    if share > 1:
        ids = ids.filter(F.pmod(F.xxhash64("doc_id"), F.lit(share)) == 0)
    return rows.join(F.broadcast(ids), "doc_id", "left_anti")


def _sorted_runs(rows: DataFrame, bits: int) -> DataFrame:
    """``(bucket, codes)``: a task's codes by their first ``bits``, sorted, as compressed
    differences. A code that two documents of a run have is there twice."""

    def packed(held: list[np.ndarray]) -> pd.DataFrame:
        codes = np.sort(np.concatenate(held))
        codes = codes[np.append([True] * min(2, len(codes)), codes[2:] != codes[:-2])]
        low = np.arange(1 << bits, dtype="u8") << np.uint64(CODE_BITS - bits)
        edges = np.append(np.searchsorted(codes, low), len(codes)).tolist()
        found = []
        for i, (begin, end) in enumerate(zip(edges, edges[1:], strict=False)):
            if begin < end:
                steps = np.diff(codes[begin:end], prepend=low[i]).astype("<u4")
                planes = np.ascontiguousarray(steps.view("u1").reshape(-1, 4).T)
                found.append((i, zlib.compress(planes.tobytes(), 1)))
        return pd.DataFrame(found, columns=["bucket", "codes"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            for text in batch["text"]:
                held.append(np.unique(_codes(anchors(_bytes(text))[0])))
                size += len(held[-1])
                if size >= RUN:
                    yield packed(held)
                    held, size = [], 0
        if size:
            yield packed(held)

    return rows.mapInPandas(run, "bucket INT, codes BINARY")


def _filter_bits(cells: int) -> int:
    return min(max(FILTER_BITS, (cells - 1).bit_length()), MOST_BITS)


def _cells(hashes: np.ndarray, parts: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """The cells of each hash, all in its part of ``1 << width`` cells."""
    spread, base = mixed(hashes), parts.astype("i8") << width
    for j in range(CELLS):
        place = (spread >> np.uint64(21 * j)) & np.uint64((1 << width) - 1)
        yield base + place.astype("i8")


def _marked(hashes: np.ndarray, width: int) -> bytes:
    """The part of a filter that holds ``hashes``."""
    marks = np.zeros(1 << width, bool)
    for cells in _cells(hashes, np.zeros(len(hashes), "i8"), width):
        marks[cells] = True
    return zlib.compress(np.packbits(marks).tobytes(), 1)


def _whole(marked: DataFrame, part_bits: int, width: int) -> np.ndarray:
    """The filter of all ``(part, bits)``."""
    found = np.zeros((1 << part_bits, (1 << width) // 8), "u1")
    for row in marked.collect():  # of a bounded size
        found[row["part"]] = np.frombuffer(zlib.decompress(row["bits"]), "u1")
    return found.reshape(-1)


def _held(bits: np.ndarray, hashes: np.ndarray, parts: np.ndarray, part_bits: int) -> np.ndarray:
    """Places of the hashes that the filter may hold."""
    width = (len(bits) * 8).bit_length() - 1 - part_bits
    found = np.arange(len(hashes))
    for cells in _cells(hashes, parts, width):
        at = cells[found]
        found = found[(bits[at >> 3] >> (7 - (at & 7)).astype("u1")) & 1 == 1]
    return found


def _code_parts(codes: np.ndarray, bits: int) -> np.ndarray:
    return codes >> np.uint64(CODE_BITS - bits)


def _shared_codes(rows: DataFrame, cells: int = 1) -> np.ndarray:
    """A filter of the codes that two documents have, of ``cells`` cells within its bounds."""
    bits = _bucket_bits(rows.sparkSession)
    width = _filter_bits(cells) - bits

    def mark(key: tuple, held: pd.DataFrame) -> pd.DataFrame:
        runs = []
        for packed in held["codes"]:
            planes = np.frombuffer(zlib.decompress(packed), "u1").reshape(4, -1)
            runs.append(np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype="u8"))
        # a run holds what is past the first code of its bucket
        codes = np.sort(np.concatenate(runs)) + (np.uint64(key[0]) << np.uint64(CODE_BITS - bits))
        shared = codes[1:][codes[1:] == codes[:-1]]
        return pd.DataFrame([(key[0], _marked(shared, width))], columns=["part", "bits"])

    marked = _sorted_runs(rows, bits).groupBy("bucket").applyInPandas(mark, "part INT, bits BINARY")
    return _whole(marked, bits, width)


def _filter(shared: DataFrame, cells: int = 1) -> np.ndarray:
    """A filter of the grams of ``shared``, of ``cells`` cells within its bounds."""
    width = _filter_bits(cells) - PIECE_BITS

    def mark(key: tuple, held: pd.DataFrame) -> pd.DataFrame:
        bits = _marked(held["gram"].to_numpy("i8").view("u8"), width)
        return pd.DataFrame([(key[0], bits)], columns=["part", "bits"])

    part = F.pmod(F.col("gram"), F.lit(1 << PIECE_BITS)).cast("int").alias("part")
    marked = shared.select(part, "gram").groupBy("part").applyInPandas(mark, "part INT, bits BINARY")
    return _whole(marked, PIECE_BITS, width)


def _occurrences(rows: DataFrame, bits: np.ndarray) -> DataFrame:
    """``(gram, context_id, doc_id, start, windows, context)`` of anchors that pass. Of equal
    contexts of a batch only one has its bytes."""
    shared = rows.sparkSession.sparkContext.broadcast(bits)
    part_bits = _bucket_bits(rows.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        names = ["gram", "doc_id", "start", "windows"]
        for batch in batches:
            held, contexts = [np.zeros((len(names), 0), "i8")], []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                whole = text.encode("utf-8")
                grams, first, last = anchors(np.frombuffer(whole, "u1"))
                codes = _codes(grams)
                passed = _held(shared.value, codes, _code_parts(codes, part_bits), part_bits)
                grams, first, last = grams[passed], first[passed], last[passed]
                held.append(np.stack([grams, np.full(len(grams), doc_id), first, last - first + 1]))
                ends = (last + WINDOW).tolist()
                contexts += [whole[a:b] for a, b in zip(first.tolist(), ends, strict=True)]
            frame = pd.DataFrame(dict(zip(names, np.concatenate(held, axis=1), strict=True)))
            ids = np.array([xxhash.xxh64_intdigest(c) for c in contexts], "u8").view("i8")
            frame = frame.assign(context_id=ids, context=pd.Series(contexts, dtype=object))
            frame.loc[frame.duplicated(["gram", "context_id"]), "context"] = None
            # a batch of long texts makes many rows, which leave in slices
            for i in range(0, len(frame), SLICE):
                yield frame.iloc[i : i + SLICE]

    schema = (
        "gram BIGINT, context_id BIGINT, doc_id BIGINT, start BIGINT, windows INT, context BINARY"
    )
    return rows.mapInPandas(run, schema)


def _with_context(found: DataFrame, bits: np.ndarray) -> DataFrame:
    """``(gram, context_id, first, context)`` of the anchors in ``bits``."""
    shared = found.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            grams = batch["gram"].to_numpy("i8")
            parts = grams & ((1 << PIECE_BITS) - 1)
            yield batch.iloc[_held(shared.value, grams.view("u8"), parts, PIECE_BITS)]

    names = ["gram", "context_id", "doc_id", "context"]
    schema = "gram BIGINT, context_id BIGINT, doc_id BIGINT, context BINARY"
    held = found.select(*names).mapInPandas(run, schema)
    return held.groupBy("gram", "context_id").agg(
        F.min("doc_id").alias("first"), F.min("context").alias("context")
    )


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in order, compared by their first ``depth`` symbols at least; the last
    symbol must be the only least one. Suffixes smaller than their successors are sorted
    directly; each other one is put into its bucket when the scan meets its successor."""
    n = len(text)
    rises = np.zeros(n, bool)  # suffix smaller than its successor
    differs = np.append(np.flatnonzero(text[1:] != text[:-1]), n - 1)
    following = differs[np.searchsorted(differs, np.arange(n))]
    inside = following < n - 1
    rises[inside] = text[following[inside]] < text[following[inside] + 1]
    rises[n - 1] = True

    small = np.flatnonzero(rises)
    padded = np.concatenate([text, np.zeros(depth, text.dtype)])
    keys = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, depth)[small])
    small = small[np.argsort(keys.view(f"S{depth}").ravel(), kind="stable")]

    sizes, of_small = np.bincount(text, minlength=256), np.bincount(text[small], minlength=256)
    ends = np.cumsum(sizes)
    small_ends, heads = np.cumsum(of_small), ends - sizes
    found = np.empty(n, "i8")

    def induced(scanned: np.ndarray, symbol: int) -> np.ndarray:
        """What stands before the scanned suffixes, if it falls, in their order."""
        before = scanned[scanned > 0] - 1
        return before[~rises[before] & (text[before] >= symbol)]

    for symbol in np.flatnonzero(sizes).tolist():
        begin, reach = ends[symbol] - sizes[symbol], heads[symbol]
        found[ends[symbol] - of_small[symbol] : ends[symbol]] = small[
            small_ends[symbol] - of_small[symbol] : small_ends[symbol]
        ]
        # a run of one symbol puts suffixes into the bucket that is being scanned
        fresh = found[begin:reach]
        while len(fresh):
            fresh = induced(fresh, symbol)
            fresh = fresh[text[fresh] == symbol]
            found[reach : reach + len(fresh)] = fresh
            reach += len(fresh)
        others = induced(found[begin : ends[symbol]], symbol)
        others = others[text[others] > symbol]
        others = others[np.argsort(text[others], kind="stable")]
        symbols = text[others]
        counts = np.bincount(symbols, minlength=256)
        found[(heads - np.cumsum(counts) + counts)[symbols] + np.arange(len(others))] = others
        heads += counts
    return found


def first_documents(contexts: list[bytes], docs: np.ndarray) -> list[np.ndarray]:
    """For each window of each context the smallest document of any context with it."""
    # bytes of UTF-8 end below 254, so 0 and 1 are free for the end and the separators
    parts = []
    for context in contexts:
        parts += [np.frombuffer(context, "u1") + np.uint8(2), np.ones(1, "u1")]
    text = np.concatenate([*parts, np.zeros(1, "u1")])
    sizes = np.array([len(c) for c in contexts])
    begins = np.cumsum(sizes + 1) - (sizes + 1)
    owner = np.repeat(np.arange(len(contexts)), sizes + 1)
    starts = np.zeros(len(text), bool)
    for begin, size in zip(begins, sizes, strict=True):
        starts[begin : begin + size - WINDOW + 1] = True
    order = suffix_array(text, WINDOW)
    order = order[starts[order]]
    common = _common_prefixes(text, order)
    run = np.flatnonzero(np.append(True, common < WINDOW))
    least = np.minimum.reduceat(docs[owner[order]], run)
    found = np.zeros(len(text), "i8")
    found[order] = np.repeat(least, np.diff(np.append(run, len(order))))
    return [found[b : b + s - WINDOW + 1] for b, s in zip(begins, sizes, strict=True)]


def _common_prefixes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Symbols that neighbours have in common, up to a window."""
    wide = np.lib.stride_tricks.sliding_window_view(text, WINDOW)
    found = np.zeros(max(len(order) - 1, 0), "i8")
    for i in range(0, len(found), 65_536):
        same = wide[order[i : i + 65_536]]
        beside = order[i + 1 : i + 65_537]
        differ = same[: len(beside)] != wide[beside]
        none = ~differ.any(axis=1)
        found[i : i + len(beside)] = np.where(none, WINDOW, differ.argmax(axis=1))
    return found


def _sorted_groups(contexts: DataFrame) -> DataFrame:
    """``(gram, context_id, firsts)`` of contexts with a window that another one has in
    an earlier document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0
        for batch in batches:
            if not len(batch):
                continue
            # a new anchor begins only where the hash changes
            if held and size > CHUNK:
                last = held[-1]["gram"].iloc[-1]
                new = batch["gram"].to_numpy() != last
                if new.any():
                    cut = int(new.argmax())
                    yield solved(pd.concat([*held, batch.iloc[:cut]]))
                    held, size, batch = [], 0, batch.iloc[cut:]
            held.append(batch)
            size += int(batch["context"].str.len().sum())
        if held:
            yield solved(pd.concat(held))

    def solved(held: pd.DataFrame) -> pd.DataFrame:
        own = held["first"].to_numpy("i8")
        firsts = first_documents(list(held["context"]), own)
        earlier = np.array([f.min() for f in firsts]) < own
        return held[["gram", "context_id"]].assign(firsts=firsts)[earlier]

    slots = shuffle_partitions(contexts.sparkSession)
    dealt = contexts.repartition(slots, "gram").sortWithinPartitions("gram")
    schema = "gram BIGINT, context_id BIGINT, firsts ARRAY<BIGINT>"
    return dealt.select("gram", "context_id", "first", "context").mapInPandas(run, schema)


def _by_window(contexts: DataFrame) -> DataFrame:
    """The same for anchors with very many contexts: equal windows meet by shuffle."""
    place = F.sequence(F.lit(0), F.length("context") - WINDOW)
    each = contexts.select("gram", "context_id", "first", "context", F.explode(place).alias("j"))
    each = each.withColumn("window", F.expr(f"substring(context, j + 1, {WINDOW})")).drop("context")
    least = each.groupBy("window").agg(F.min("first").alias("least"))
    joined = each.join(least, "window").groupBy("gram", "context_id")
    pairs = F.sort_array(F.collect_list(F.struct("j", "least")))
    return joined.agg(F.transform(pairs, lambda p: p["least"]).alias("firsts"))


def repeated_spans(rows: DataFrame) -> DataFrame:
    """``(doc_id, begins, ends)``: the bytes that an earlier document has, as runs."""
    digests = _digests(rows)
    copies = _copies(digests)
    rows = _without(rows, copies)
    n_bytes = digests.agg(F.sum("size")).first()[0] or 0
    n_anchors = 2 * n_bytes // (WINDOW - GRAM + 2)
    found = materialize(_occurrences(rows, _shared_codes(rows, 2 * n_anchors)), "occurrences")
    key = ["gram", "context_id"]
    contexts = found.groupBy(*key).agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("n")
    )
    contexts = materialize(contexts, "contexts")
    sizes = contexts.groupBy("gram").agg(F.count("*").alias("size")).filter("size > 1")
    sizes = materialize(sizes, "sizes")
    several = materialize(_with_context(found, _filter(sizes, 16 * sizes.count())), "several")
    crowded = sizes.filter(F.col("size") > MANY).select("gram")
    n_crowded = crowded.count()
    if n_crowded:
        if n_crowded <= MAX_BROADCAST:
            crowded = F.broadcast(crowded)
        few = _sorted_groups(several.join(crowded, "gram", "left_anti"))
        firsts = few.unionByName(_by_window(several.join(crowded, "gram", "left_semi")))
    else:
        firsts = _sorted_groups(several)
    firsts = materialize(firsts, "firsts")

    lookup = contexts.join(firsts, key, "left").filter("firsts is not null or first < last")
    lookup = materialize(lookup.select(*key, "first", "n", "firsts"), "repeats")
    narrow = found.select(*key, "doc_id", "start", "windows")
    met = join_by_share(narrow, lookup, key, "n", found.count()).filter("n is not null")

    def span(begin: Column, windows: Column) -> Column:
        end = (begin + windows + (WINDOW - 1)).cast("bigint")
        return F.shiftleft(begin.cast("bigint"), END_BITS).bitwiseOR(end)

    every = F.sequence(F.lit(0), F.col("windows") - 1)
    later = F.filter(every, lambda j: F.get("firsts", j) < F.col("doc_id"))
    whole = F.when(F.col("first") < F.col("doc_id"), F.array(span(F.col("start"), F.col("windows"))))
    spans = F.when(F.col("firsts").isNull(), whole).otherwise(
        F.transform(later, lambda j: span(F.col("start") + j, F.lit(1)))
    )
    spans = met.select("doc_id", spans.alias("spans")).filter(F.size("spans") > 0)
    all_of = F.array(span(F.lit(0), F.col("size") - (WINDOW - 1)))
    spans = spans.unionByName(copies.select("doc_id", all_of.alias("spans")))
    by_document = spans.groupBy("doc_id").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    return by_document.mapInPandas(
        _merged, "doc_id BIGINT, begins ARRAY<BIGINT>, ends ARRAY<BIGINT>"
    )


def _merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for doc_id, spans in zip(batch["doc_id"], batch["spans"], strict=True):
            spans = np.sort(np.asarray(spans, "i8"))
            begins = spans >> END_BITS
            reach = np.maximum.accumulate(spans & ((1 << END_BITS) - 1))
            new = np.append(True, begins[1:] > reach[:-1])
            out.append((doc_id, begins[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)]))
        yield pd.DataFrame(out, columns=["doc_id", "begins", "ends"])


def suffix_dedup(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept)`` of each row: its size, the bytes
    removed, the runs they make, and the bytes that remain.

    A null text is empty. Texts shorter than a window are kept whole, as are rows without
    an identifier, and neither makes another lose bytes if it has no window. Rows that
    repeat an identifier should have equal texts and lose the same bytes. An empty table
    gives no rows.
    """
    ship_package(docs.sparkSession)
    rows = id_and_text(docs)
    spans = materialize(repeated_spans(rows.filter("doc_id is not null")), "spans")

    n_runs = spans.agg(F.sum(F.size("begins"))).first()[0] or 0
    if n_runs <= MAX_BROADCAST:  # beyond that the texts shuffle
        spans = F.broadcast(spans)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, begins, ends in zip(batch["text"], batch["begins"], batch["ends"], strict=True):
                raw = text.encode("utf-8")
                kept, past = [], 0
                runs = [] if begins is None else list(zip(begins, ends, strict=True))
                for begin, end in runs:
                    kept.append(raw[past:begin])
                    past = end
                kept = b"".join([*kept, raw[past:]])
                out.append((len(raw), len(raw) - len(kept), len(runs), kept))
            frame = pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept"])
            yield frame.assign(doc_id=whole_ids(batch["doc_id"]))

    schema = "n_bytes BIGINT, n_removed BIGINT, n_spans BIGINT, kept BINARY, doc_id BIGINT"
    return exact_ids(rows.join(spans, "doc_id", "left")).mapInPandas(run, schema)
