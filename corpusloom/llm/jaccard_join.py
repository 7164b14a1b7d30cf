"""Documents linked by the Jaccard similarity of their five-word shingles.

T-occurrence search after DivideSkip. The lists of the documents that hold a shingle
are divided into short and long ones by one order for all documents: shingles that a
sketch of the whole corpus finds in many documents come last. A document with n
shingles that must share T with another sets its T - 1 last lists aside as long; the
other n - T + 1 are short, and whoever reaches T is on one of them. Short lists are
merged, which counts how often two documents meet; what both could still share on the
long lists bounds the rest, and pairs below the required overlap go. The others probe
their sets by binary search, for the exact overlap. Lists with the same members, as of a
passage that these share, are one list with a weight.

Copies would make all pairs of a long list. Documents with equal sets are one to begin
with. Then each list links its members to few pivots only, in rounds, and documents
already in one component are not compared again. What remains are mostly documents edited
too far to be linked: each outside a list's largest component is held against the others
of that list by parity bitmaps. An element in one of two sets flips one bit, so bitmaps
that differ in more bits than linked sets do in elements rule a pair out where the lists
are joined; large sets, which fill a bitmap, have a wider one as well. So components are those of all links, and no link between two components is
passed over.

Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import exact_ids, id_and_text, join_by_share, ship_package, whole_ids
from corpusloom.llm.components import components
from corpusloom.llm.hashing import INVERSE, mixed, powers
from corpusloom.workspace import materialize

N = 5
PERCENT = 80
# Size of the sketch, which is the same for any corpus, and its pieces in a shuffle.
SKETCH_BITS = 22
SKETCH_PIECES = 16
OFTEN = 16
MAX_ROUNDS = 8
PAIRS_PER_ROW = 4
# Pivots of an open list from the second round on, and those a document is held against in
# a round. Rounds end with one that finds fewer than one link in so many of the first.
PIVOTS = 4
WORTH = 20
MAX_BROADCAST = 500_000
# Words of 64 bits in a parity bitmap, and in the second one that sets have which are as
# large as the first has bits.
WORDS = 16
WIDE_WORDS = 64
BITMAP = [f"w{i}" for i in range(WORDS)]


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words, lower-cased ASCII-wise and ended by ASCII white
    space: polynomials in the bytes of a word, as differences of running sums."""
    raw = np.frombuffer(text.encode("utf-8").lower(), "u1")
    if not len(raw):
        return np.zeros(0, "u8")
    up, down = powers(len(raw))
    space = np.ones(len(raw) + 2, bool)
    space[1:-1] = _SPACE[raw]
    edges = np.flatnonzero(space[1:] != space[:-1])
    first, beyond = edges[::2], edges[1::2]
    sums = np.zeros(len(raw) + 1, "u8")
    np.cumsum((raw.astype("u8") + np.uint64(1)) * up[: len(raw)], out=sums[1:])
    sizes = (beyond - first).astype("u8")
    return mixed((sums[beyond] - sums[first]) * down[first] + sizes * np.uint64(INVERSE))


def shingle_set(text: str, n: int = N) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles. Fewer than ``n`` words make one
    shingle, none none."""
    codes = word_hashes(text)
    width = min(n, len(codes))
    if not width:
        return codes
    found = np.full(len(codes) - width + 1, width, "u8")
    for i in range(width):
        found = mixed(found + codes[i : len(codes) - width + 1 + i])
    return np.unique(found)


def least_overlap(n: int, percent: int = PERCENT) -> int:
    """Fewest shingles that a document of ``n`` shares with any it is linked to."""
    return -(-percent * n // 100)


def _sketch_pass(docs: DataFrame, n: int) -> DataFrame:
    """Each document's set size and two signatures of its set; with them, from each
    task, how many documents it has for each cell of the sketch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cells = np.zeros(1 << SKETCH_BITS, "i8")
        for batch in batches:
            sets = [shingle_set(text, n) for text in batch["text"]]
            met = np.concatenate([np.zeros(0, "u8"), *sets]) >> np.uint64(64 - SKETCH_BITS)
            cells += np.bincount(met.astype("i8"), minlength=len(cells))
            rows = [(len(found), *_signature(found)) for found in sets]
            frame = pd.DataFrame(rows, columns=["n", "sig_a", "sig_b"])
            yield frame.assign(doc_id=whole_ids(batch["doc_id"]), piece=-1, counts=None)
        for piece, part in enumerate(np.split(cells, SKETCH_PIECES)):
            if part.any():
                empty = {"n": 0, "sig_a": 0, "sig_b": 0, "doc_id": pd.NA}
                row = pd.DataFrame([empty | {"piece": piece, "counts": zlib.compress(part.astype("<i8").tobytes(), 1)}])
                yield row.astype({"doc_id": "Int64"})

    schema = "doc_id BIGINT, n BIGINT, sig_a BIGINT, sig_b BIGINT, piece INT, counts BINARY"
    return exact_ids(id_and_text(docs)).mapInPandas(run, schema)


def _signature(found: np.ndarray) -> tuple[int, int]:
    import xxhash

    held = found.tobytes()
    pair = (xxhash.xxh64_intdigest(held, seed) for seed in (1, 2))
    a, b = (int(np.uint64(x).view("i8")) for x in pair)
    return a, b


def _often(passed: DataFrame) -> np.ndarray:
    """Cells of the sketch far above the mean, one bool for each."""

    def add(key: tuple, held: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros((1 << SKETCH_BITS) // SKETCH_PIECES, "i8")
        for x in held["counts"]:
            total += np.frombuffer(zlib.decompress(x), "<i8")
        packed = zlib.compress(total.tobytes(), 1)
        return pd.DataFrame([(key[0], packed)], columns=["piece", "counts"])

    pieces = passed.filter("piece >= 0").select("piece", "counts")
    summed = pieces.groupBy("piece").applyInPandas(add, "piece INT, counts BINARY")
    size = 1 << SKETCH_BITS
    cells = np.zeros(size, "i8")
    for row in summed.collect():  # the sketch has a fixed size
        width = size // SKETCH_PIECES
        cells[row["piece"] * width : (row["piece"] + 1) * width] = np.frombuffer(
            zlib.decompress(row["counts"]), "i8"
        )
    mean = cells.mean()
    return cells > mean + max(OFTEN, 6 * mean**0.5)


def _chosen(short: DataFrame, classes: DataFrame) -> DataFrame:
    """One document of each class; the others have its set."""
    ids = classes.select(F.col("class_id").alias("doc_id"))
    return short.join(ids, "doc_id", "left_semi").dropDuplicates(["doc_id"])


def _short_lists(docs: DataFrame, often: np.ndarray, n: int, percent: int) -> DataFrame:
    """``(doc_id, n, short, many, bits, wide)``: hashes of a document's short lists, those of
    common cells in ``many``, and the parity bitmaps of its set."""
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(often))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        common = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                found = shingle_set(text, n)
                if not len(found):
                    continue
                late = common[(found >> np.uint64(64 - SKETCH_BITS)).astype("i8")]
                size = len(found) - least_overlap(len(found), percent) + 1
                short = found[~late][:size]
                many = found[late][: size - len(short)]
                wide = _bitmap(found, WIDE_WORDS) if len(found) >= 64 * WORDS else None
                lists = short.view("i8"), many.view("i8")
                rows.append((doc_id, len(found), *lists, _bitmap(found, WORDS), wide))
            yield pd.DataFrame(rows, columns=["doc_id", "n", "short", "many", "bits", "wide"])

    schema = "doc_id BIGINT, n BIGINT, short ARRAY<BIGINT>, many ARRAY<BIGINT>"
    schema += ", bits ARRAY<BIGINT>, wide ARRAY<BIGINT>"
    return docs.mapInPandas(run, schema)


def _bitmap(found: np.ndarray, words: int) -> np.ndarray:
    """For each bit whether an odd number of elements fall on it."""
    bits = (found & np.uint64(64 * words - 1)).astype("i8")
    odd = (np.bincount(bits, minlength=64 * words) & 1).astype(bool)
    return np.packbits(odd).view("i8")


def _shared_lists(short: DataFrame) -> DataFrame:
    """``(hash, id, n)`` of the lists that have two documents or more."""
    id_ = F.col("doc_id").alias("id")
    few = short.select(F.explode("short").alias("hash"), id_, "n")
    # a list of a cell that is not common is no longer than the cell's count
    sized = few.withColumn("size", F.count("*").over(Window.partitionBy("hash")))
    few = sized.filter("size > 1").drop("size")
    many = short.filter(F.size("many") > 0).select(F.explode("many").alias("hash"), id_, "n")
    held = many.groupBy("hash").agg(F.count("*").alias("size")).filter("size > 1")
    return few.unionByName(many.join(held.select("hash"), "hash"))


def _weighted(lists: DataFrame) -> DataFrame:
    """Lists with the same members as one, its ``weight`` their number. Members are
    compared by two independent hashes of the set."""
    members = [F.bit_xor(F.xxhash64("id")).alias("one"), F.bit_xor(F.xxhash64(F.lit(1), "id")).alias("two")]
    held = lists.groupBy("hash").agg(*members)
    kept = held.groupBy("one", "two").agg(F.min("hash").alias("hash"), F.count("*").alias("weight"))
    return lists.join(kept.select("hash", "weight"), "hash")


def _pair_filter(percent: int):
    low, high = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    return 100 * low >= percent * high


def _sets(docs: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """``(id, found)``: the sorted hashes of the documents in ``ids``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingle_set(t, n).tobytes() for t in batch["text"]]
            yield pd.DataFrame({"id": batch["doc_id"], "found": sets})

    ids = ids.select(F.col("id").alias("doc_id"))
    if ids.count() <= MAX_BROADCAST:  # 8 bytes each; beyond that the join shuffles
        ids = F.broadcast(ids)
    wanted = docs.join(ids, "doc_id", "left_semi")
    return wanted.mapInPandas(run, "id BIGINT, found BINARY").dropDuplicates(["id"])


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose exact similarity is high enough."""

    @F.pandas_udf("boolean")
    def linked(one: pd.Series, other: pd.Series) -> pd.Series:
        return pd.Series([_linked(x, y, percent) for x, y in zip(one, other, strict=True)])

    of_a = sets.select(F.col("id").alias("a"), F.col("found").alias("set_a"))
    of_b = sets.select(F.col("id").alias("b"), F.col("found").alias("set_b"))
    met = pairs.select("a", "b").join(of_a, "a").join(of_b, "b")
    return met.filter(linked("set_a", "set_b")).select("a", "b")


def _linked(one: bytes, other: bytes, percent: int) -> bool:
    x, y = np.frombuffer(one, "u8"), np.frombuffer(other, "u8")
    if len(x) > len(y):
        x, y = y, x
    places = np.searchsorted(y, x)
    places[places == len(y)] = 0
    both = int((y[places] == x).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def _placed(lists: DataFrame, found: DataFrame | None) -> DataFrame:
    """The lists with the component each member has so far."""
    if found is None:
        return lists.withColumn("component", F.col("id"))
    known = found.select("id", F.col("component_id").alias("component"))
    return lists.join(known, "id", "left").withColumn("component", F.coalesce("component", "id"))


def _open_lists(rows: DataFrame) -> DataFrame:
    """Members of lists that still have two components or more, with the list's
    ``size``, its ``largest`` component and how many are ``outside`` it."""
    held = rows.groupBy("hash", "component").agg(F.count("*").alias("members"))
    lists = held.groupBy("hash").agg(
        F.sum("members").alias("size"),
        F.max(F.struct("members", "component")).alias("most"),
        F.count("*").alias("parts"),
    )
    kept = lists.filter("parts > 1").select(
        "hash",
        "size",
        F.col("most.component").alias("largest"),
        (F.col("size") - F.col("most.members")).alias("outside"),
    )
    return rows.join(kept, "hash")


def _pivot_pairs(rows: DataFrame, bitmaps: DataFrame, round_: int, percent: int) -> DataFrame:
    """For each document the pivots of other components that it meets most often, of
    those that could be enough and that bitmaps do not rule out; it meets a pivot only
    on lists where it is the pivot."""
    seeds = range(PIVOTS * round_, PIVOTS * (round_ + 1))
    orders = [F.xxhash64("id", F.lit(s)) for s in seeds] if round_ else [F.col("id")]
    firsts = [F.min(F.struct(o.alias("order"), "id", "n", "component")) for o in orders]
    names = [f"p{i}" for i in range(len(firsts))]
    each = [
        F.struct(
            F.col(p)["id"].alias("a"), F.col(p)["n"].alias("n_a"), F.col(p)["component"].alias("of_a")
        )
        for p in names
    ]
    held = rows.groupBy("hash").agg(*[f.alias(p) for f, p in zip(firsts, names, strict=True)])
    pivots = held.select("hash", F.inline(F.array_distinct(F.array(*each))))
    members = rows.select(
        "hash", "weight", F.col("id").alias("b"), F.col("n").alias("n_b"), "component"
    )
    met = members.join(pivots, "hash").filter((F.col("of_a") != F.col("component")) & _pair_filter(percent))
    counted = met.groupBy("a", "b", "n_a", "n_b").agg(F.sum("weight").alias("times"))
    close = counted.filter(_enough(F.col("times"), percent))
    for end in ("a", "b"):
        bits = [F.col(w).alias(f"{w}_{end}") for w in (*BITMAP, "wide")]
        close = close.join(bitmaps.select(F.col("id").alias(end), *bits), end)
    top = F.struct("times", (-F.col("a")).alias("less"))
    best = close.filter(_alike(percent)).groupBy("b").agg(F.sort_array(F.collect_list(top), False).alias("top"))
    each = best.select("b", F.explode(F.slice("top", 1, PIVOTS)).alias("top"))
    return each.select((-F.col("top.less")).alias("a"), "b")


def _all_pairs(rows: DataFrame, bitmaps: DataFrame, percent: int) -> DataFrame:
    """Pairs between components that meet often enough on short lists and whose bitmaps
    do not rule them out. A document on few open lists cannot meet another often enough
    that is about as long, so such pairs are ruled out before they are counted."""
    opened = rows.groupBy("id").agg(F.sum("weight").alias("open"))
    rows = rows.join(bitmaps.join(opened, "id"), "id")

    def side(x: str) -> list:
        names = {"id": x, "n": f"n_{x}", "component": f"of_{x}", "open": f"open_{x}"}
        names |= {w: f"{w}_{x}" for w in (*BITMAP, "wide")}
        return [F.col(c).alias(name) for c, name in names.items()]

    in_largest = F.col("component") == F.col("largest")
    outside = rows.filter(~in_largest).select("hash", "weight", *side("a"))
    others = rows.select("hash", *side("b"), in_largest.alias("in_largest"))
    once = F.col("in_largest") | (F.col("a") < F.col("b"))
    met = outside.join(others, "hash").filter(
        (F.col("of_a") != F.col("of_b"))
        & once
        & _pair_filter(percent)
        & _enough(F.least("open_a", "open_b"), percent)
        & _alike(percent)
    )
    one, other = F.least("a", "b"), F.greatest("a", "b")
    sizes = (
        F.when(F.col("a") < F.col("b"), F.col("n_a")).otherwise(F.col("n_b")),
        F.when(F.col("a") < F.col("b"), F.col("n_b")).otherwise(F.col("n_a")),
    )
    counted = (
        met.select(
            one.alias("a"), other.alias("b"), sizes[0].alias("n_a"), sizes[1].alias("n_b"), "weight"
        )
        .groupBy("a", "b", "n_a", "n_b")
        .agg(F.sum("weight").alias("times"))
    )
    return counted.filter(_enough(F.col("times"), percent)).select("a", "b")


def _needed(percent: int):
    """The least overlap of a linked pair."""
    return F.ceil(percent * (F.col("n_a") + F.col("n_b")) / (100 + percent))


def _alike(percent: int):
    """Whether the bitmaps differ in no more bits than linked sets do in elements."""
    differ = reduce(add, [F.bit_count(F.col(f"{w}_a").bitwiseXOR(F.col(f"{w}_b"))) for w in BITMAP])
    most = F.col("n_a") + F.col("n_b") - 2 * _needed(percent)
    each = F.zip_with("wide_a", "wide_b", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    # looked at only where the first bitmaps, which a large set fills, rule nothing out
    wide = F.coalesce(F.aggregate(each, F.lit(0), add) <= most, F.lit(True))
    return F.when(differ <= most, wide).otherwise(False)


def _enough(times: Column, percent: int) -> Column:
    """Whether the least overlap of a pair can be reached: ``times`` on short lists and
    the most it can still share on long ones."""
    long = F.greatest(*[F.ceil(percent * F.col(x) / 100) - 1 for x in ("n_a", "n_b")])
    return times >= _needed(percent) - long


def _joined(found: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components after further ``links``, which are followed between components."""
    if found is None:
        return components(links)
    ends = links
    for end in ("a", "b"):
        root = found.select(F.col("id").alias(end), F.col("component_id").alias(f"of_{end}"))
        ends = ends.join(root, end, "left").withColumn(f"of_{end}", F.coalesce(f"of_{end}", end))
    merged = components(ends.select(F.col("of_a").alias("a"), F.col("of_b").alias("b")))
    new = merged.select(F.col("id").alias("component_id"), F.col("component_id").alias("root"))
    old = found.join(new, "component_id", "left")
    old = old.select("id", F.coalesce("root", "component_id").alias("component_id"))
    return old.unionByName(merged.join(found.select("id"), "id", "left_anti"))


def near_duplicates(docs: DataFrame, percent: int = PERCENT, n: int = N) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, one row for each row.

    Two documents are linked if ``100 * intersection >= percent * union`` of their sets
    of ``n``-word shingles; the component is the smallest identifier that links reach. A
    null, empty or blank text has no shingles and is linked with nothing. Rows that
    repeat an identifier should have equal texts and share the verdict. Rows without an
    identifier are returned with a null component and linked with nothing. An empty
    table gives no rows.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = id_and_text(docs)
    passed = materialize(_sketch_pass(rows, n), "signatures")
    signed = passed.filter("piece < 0").select("doc_id", "n", "sig_a", "sig_b")
    key = ["n", "sig_a", "sig_b"]
    usable = signed.filter("doc_id is not null and n > 0")
    classes = materialize(
        usable.groupBy(*key).agg(F.min("doc_id").alias("class_id"), F.count("*").alias("copies")),
        "classes",
    )
    whole = rows.filter("doc_id is not null")
    short = materialize(_short_lists(whole, _often(passed), n, percent), "short-lists")
    lists = materialize(_shared_lists(_chosen(short, classes)), "shared-lists")
    lists = materialize(_weighted(lists), "lists")

    words = [F.col("bits")[i].alias(w) for i, w in enumerate(BITMAP)]
    bitmaps = short.select(F.col("doc_id").alias("id"), *words, "wide").dropDuplicates(["id"])

    found, exact, n_first = None, False, 0
    for round_ in range(MAX_ROUNDS + 1):
        open_rows = materialize(_open_lists(_placed(lists, found)), "open-lists")
        outside = open_rows.filter(F.col("component") != F.col("largest"))
        left, work = outside.agg(F.count("*"), F.sum("size")).first()
        if not left:
            break
        if round_ == 0:
            pairs = _pivot_pairs(open_rows, bitmaps, round_, percent)
        else:
            exact = exact or work <= PAIRS_PER_ROW * left or round_ == MAX_ROUNDS
            pairs = (
                _all_pairs(open_rows, bitmaps, percent)
                if exact
                else _pivot_pairs(open_rows, bitmaps, round_, percent)
            )
        pairs = materialize(pairs, "pairs")
        ends = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
        sets = materialize(_sets(whole, materialize(ends, "ends"), n), "sets")
        new = materialize(_verified(pairs, sets, percent), "links")
        n_new = new.count()
        n_first = n_first if round_ else n_new
        if n_new:
            found = materialize(_joined(found, new), "components")
        if exact:
            break
        exact = n_new * WORTH < n_first

    named = classes.withColumnRenamed("class_id", "id")
    if found is not None:
        named = named.join(found, "id", "left")
        named = named.withColumn("component_id", F.coalesce("component_id", "id"))
    else:
        named = named.withColumn("component_id", F.col("id"))
    named = materialize(named.select(*key, "component_id", "copies"), "named")
    total = usable.count()
    of_usable = join_by_share(usable, named, key, "copies", total)
    alone = signed.filter("doc_id is null or n = 0").withColumn("component_id", F.col("doc_id"))
    return (
        of_usable.select("doc_id", "n", "component_id")
        .unionByName(alone.select("doc_id", "n", "component_id"))
        .withColumnRenamed("n", "n_shingles")
    )
