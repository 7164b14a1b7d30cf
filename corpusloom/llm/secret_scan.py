"""Secrets in texts: fixed patterns, and a battery of randomness tests for the rest.

Candidates for the battery are long tokens with a digit, or with a capital behind a small
letter, that no pattern covers; without either a token is a word or a rule of signs. The
alphabet a token is written in is inferred from its characters. Three tests ask
whether the token could be uniform noise over that alphabet: chi-squared of the
symbol counts, runs above and below the middle of the alphabet, and serial
correlation of neighbours. Fisher's method combines them into one p-value.

Noise has uniform p-values, ordinary text piles up near 0. Within each band of
lengths the p-values from one half up therefore tell how much noise there is, and
what exceeds its share beyond a cutoff is ordinary text. The cutoff of the band is
the smallest one at which the estimated share of ordinary text is at most ``fdr``.
Every distinct token counts once, however many copies it has. ``WEIGHT`` tokens spread
like those of all bands are added to each band, and as many of uniform noise to those of
all bands. The fewer tokens a band has, the more it leans on the others, and these on
noise, without a number from which on another rule holds.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import let
from corpusloom.workspace import materialize

# The patterns and least lengths of the base kinds, in their order.
ASSIGN = (
    r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ASSIGN_LEAST = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "random")

LEAST = 16
RUN = "[A-Za-z0-9+/_=-]"
MIXED = "[A-Z0-9+/_=-]*+[a-z][a-z0-9+/_=-]*+[A-Z]"
TOKEN = rf"(?<!{RUN})(?={RUN}{{{LEAST}}})(?:[A-Za-z+/_=-]*+[0-9]|{MIXED}){RUN}*+"

# Alphabets by the pattern a token must match; the first that fits is inferred.
DIGITS = "0123456789"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = (
    ("hex", "^[0-9a-f]+$", DIGITS + "abcdef"),
    ("hex", "^[0-9A-F]+$", DIGITS + "ABCDEF"),
    ("base32", "^[A-Z2-7]+=*$", UPPER + "234567"),
    ("base64", "^[A-Za-z0-9+/_=-]+$", UPPER + UPPER.lower() + DIGITS + "+/"),
)
# Least lengths of the bands within which false discoveries are controlled.
BANDS = (16, 20, 24, 32, 40, 64, 128)
BINS = 100
FDR = 0.05
WEIGHT = 100

SPAN = "array<struct<start:int,rank:int,end:int,value:string>>"


def _halvings(values: Column) -> Column:
    """How often an array that is not empty can be halved, rounded up."""
    return F.ceil(F.log2(F.size(values).cast("double"))).cast("int")


def _power(k: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1), k)


def running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """``values`` combined with all before them, by passes over the array that each reach
    twice as far back; ``combine`` gets null where nothing lies before. Not for an empty
    array."""

    def further(a: Column, k: Column) -> Column:
        return F.transform(a, lambda x, i: combine(x, F.get(a, i - _power(k))))

    return F.aggregate(F.sequence(F.lit(0), _halvings(values)), values, further)


def _sums(values: Column) -> Column:
    return running(values, lambda x, before: x + F.coalesce(before, F.lit(0)))


def _maxima(values: Column) -> Column:
    return running(values, lambda x, before: F.greatest(x, F.coalesce(before, F.lit(0))))


def _below(ordered: Column, bound: Column) -> Column:
    """How many of ``ordered``, ascending and not empty, are less than ``bound``."""

    def closer(at: Column, k: Column) -> Column:
        reached = at + _power(k)
        return F.when(F.get(ordered, reached - 1) < bound, reached).otherwise(at)

    return F.aggregate(F.sequence(_halvings(ordered), F.lit(0), F.lit(-1)), F.lit(0), closer)


def matches(text: Column, pattern: str, rank: int, group: int = 0) -> Column:
    """All leftmost matches as ``(start, rank, end, value of the group)``, by code
    points: the lengths of the pieces between them give their places."""

    def placed(pieces: Column, whole: Column, values: Column) -> Column:
        lengths = F.transform(whole, lambda m, i: F.length(F.get(pieces, i)) + F.length(m))
        return let(
            _sums(lengths),
            lambda ends: F.transform(
                whole,
                lambda m, i: F.struct(
                    (F.get(ends, i) - F.length(m)).alias("start"),
                    F.lit(rank).alias("rank"),
                    F.get(ends, i).alias("end"),
                    F.get(values, i).alias("value"),
                ),
            ),
        )

    found = let(
        F.split(text, pattern, -1),
        lambda pieces: let(
            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
            lambda whole: let(
                whole if not group else F.regexp_extract_all(text, F.lit(pattern), F.lit(group)),
                lambda values: placed(pieces, whole, values),
            ),
        ),
    )
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(SPAN))


def _tail(z: Column) -> Column:
    """P(|N(0,1)| > z) for z >= 0; rational approximation of the error function,
    right to 1.2e-7 of its value."""
    x = z / math.sqrt(2)
    t = 1 / (1 + x / 2)
    # Coefficients of the approximation, lowest power first.
    powers = (
        -1.26551223,
        1.00002368,
        0.37409196,
        0.09678418,
        -0.18628806,
        0.27886807,
        -1.13520398,
        1.48851587,
        -0.82215223,
        0.17087277,
    )
    series = F.lit(powers[-1])
    for c in reversed(powers[:-1]):
        series = series * t + c
    return t * F.exp(series - x * x)


def _battery(symbols: Column, k: int) -> Column:
    """Combined p-value of a token, given as the places of its symbols in an
    alphabet of ``k``."""
    n = F.size(symbols)
    squares = F.aggregate(
        F.array_distinct(symbols),
        F.lit(0.0),
        lambda a, s: a + F.pow(F.size(F.filter(symbols, lambda x: x == s)).cast("double"), 2),
    )
    neighbours = F.transform(
        F.sequence(F.lit(0), n - 2),
        lambda i: F.struct(F.get(symbols, i).alias("a"), F.get(symbols, i + 1).alias("b")),
    )
    middle = (k - 1) / 2
    spread = (k * k - 1) / 12
    sums = F.aggregate(
        neighbours,
        F.struct(F.lit(0.0).alias("turns"), F.lit(0.0).alias("products")),
        lambda acc, x: F.struct(
            (
                acc["turns"]
                + F.when((x["a"] > middle) != (x["b"] > middle), 1.0).otherwise(0.0)
            ).alias("turns"),
            (acc["products"] + (x["a"] - middle) * (x["b"] - middle)).alias("products"),
        ),
    )

    def combine(s: Column) -> Column:
        # mean and variance of chi-squared for a multinomial of this length
        chi = squares * k / n - n
        z_chi = (chi - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
        p_chi = F.when(z_chi > 0, _tail(F.abs(z_chi)) / 2).otherwise(1 - _tail(F.abs(z_chi)) / 2)
        z_runs = (s["turns"] - (n - 1) / 2) / F.sqrt((n - 1) / 4)
        z_serial = s["products"] / (spread * F.sqrt(n - 1))
        logs = sum(
            -F.log(F.greatest(p, F.lit(1e-300)))
            for p in (p_chi, _tail(F.abs(z_runs)), _tail(F.abs(z_serial)))
        )
        return let(logs, lambda h: F.exp(-h) * (1 + h + h * h / 2))

    return let(sums, combine)


def randomness(value: Column) -> Column:
    """p-value of a token under uniform noise over its inferred alphabet; null for
    numbers and for words of one case or with a leading capital, which are not tested."""
    plain = F.translate(value, "-_=", "+/")
    untested = ~value.rlike("[A-Za-z]") | ~(value.rlike("[0-9]") | value.rlike(f"^{MIXED}"))
    found = F.when(untested, F.lit(None).cast("double"))
    for _, pattern, alphabet in ENCODINGS:
        symbols = F.transform(
            F.filter(F.split(plain, ""), lambda c: c != ""),
            lambda c, alphabet=alphabet: F.instr(F.lit(alphabet), c) - 1,
        )
        tested = let(symbols, lambda s, k=len(alphabet): F.when(F.size(s) >= LEAST, _battery(s, k)))
        found = found.when(value.rlike(pattern), tested)
    return found


def _apart(tokens: Column, base: Column) -> Column:
    """The tokens that overlap none of ``base``, which is ordered by start and not empty: of
    the spans that start before a token ends, none may reach beyond the token's start."""

    def kept(starts: Column, reach: Column) -> Column:
        return F.filter(
            tokens,
            lambda t: F.coalesce(F.get(reach, _below(starts, t["end"]) - 1), F.lit(0)) <= t["start"],
        )

    return let(base["start"], lambda starts: let(_maxima(base["end"]), lambda reach: kept(starts, reach)))


def scan(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` with ``base`` spans and ``candidates`` of the battery
    with their p-values."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    held = docs.select(F.struct(*docs.columns).alias("row"), text.alias("text"))
    text = F.col("text")
    assign = F.filter(matches(text, ASSIGN, 0, 2), lambda m: F.length(m["value"]) >= ASSIGN_LEAST)
    base = F.array_sort(F.concat(assign, matches(text, ACCESS, 1), matches(text, HEX, 2)))
    found = held.select("row", base.alias("base"), matches(text, TOKEN, 3).alias("tokens"))
    free = F.when((F.size("base") == 0) | (F.size("tokens") == 0), F.col("tokens")).otherwise(
        let(F.col("base"), lambda b: _apart(F.col("tokens"), b))
    )
    tested = F.transform(
        free,
        lambda t: F.struct(
            t["start"].alias("start"),
            t["rank"].alias("rank"),
            t["end"].alias("end"),
            t["value"].alias("value"),
            randomness(t["value"]).alias("p"),
        ),
    )
    return found.select("row", "base", tested.alias("candidates"))


def cutoffs(scanned: DataFrame, fdr: float = FDR) -> list[float]:
    """The least p-value that counts as noise, by band of lengths. The driver sees
    one histogram of at most ``BINS`` counts for each band, of distinct tokens."""
    found = scanned.select(F.explode("candidates").alias("c")).filter(F.col("c.p").isNotNull())
    each = found.groupBy(F.col("c.value").alias("value")).agg(F.min("c.p").alias("p"))
    band = sum(F.when(F.length("value") >= least, 1).otherwise(0) for least in BANDS) - 1
    cell = F.least(F.floor(F.col("p") * BINS), F.lit(BINS - 1))
    counts = [[0] * BINS for _ in BANDS]
    for row in each.groupBy(band.alias("band"), cell.alias("cell")).count().collect():
        counts[row["band"]][row["cell"]] = row["count"]
    return _by_band(counts, fdr)


def _by_band(counts: list[list[int]], fdr: float) -> list[float]:
    """The cutoff of each band, whose counts are drawn towards those of all bands, and
    these towards uniform noise."""
    pool = [sum(cells) for cells in zip(*counts)]
    shape = [(n + WEIGHT / BINS) / (sum(pool) + WEIGHT) for n in pool]
    return [_cutoff([n + WEIGHT * s for n, s in zip(own, shape)], fdr) for own in counts]


def _cutoff(histogram: list[float], fdr: float) -> float:
    above = list(accumulate(reversed(histogram)))[::-1]
    half = BINS // 2
    noise = 2 * above[half]
    for cell in range(1, half):
        ordinary = above[cell] - noise * (BINS - cell) / BINS
        if above[cell] and ordinary <= fdr * above[cell]:
            return cell / BINS
    return 0.5


def find_secrets(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """The columns of ``docs``, then ``base`` and ``spans``: arrays of ``(start, rank,
    end, value)`` by start, ``rank`` being the place of the kind in ``KINDS``.

    ``spans`` has the base spans and those the battery adds, which overlap none of
    them. A null or empty text has no spans, a long one takes time nearly in proportion to
    its spans; repeated rows are scanned one by one; an empty table gives no rows. Other columns of ``docs`` are kept, except ones named
    ``base`` or ``spans``, whose places the result takes.
    """
    scanned = materialize(scan(docs), "secrets")
    least = F.array(*[F.lit(c) for c in cutoffs(scanned, fdr)])

    def noise(c: Column) -> Column:
        band = sum(F.when(F.length(c["value"]) >= b, 1).otherwise(0) for b in BANDS) - 1
        return c["p"] >= F.get(least, band)

    added = F.transform(
        F.filter(F.col("candidates"), noise),
        lambda c: F.struct(*[c[f].alias(f) for f in ("start", "rank", "end", "value")]),
    )
    spans = F.array_sort(F.concat("base", added))
    own = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in ("base", "spans")]
    return scanned.select(*own, "base", spans.alias("spans"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.get(kinds, s["rank"]), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """``text`` with every span replaced by ``mark``; spans that overlap become one.

    A text with spans is cut where each character has four bytes, since a place in it would
    be counted from the beginning for every span otherwise; such a text may have 2^29
    characters.
    """

    def between(wide: Column, begin: Column, end: Column) -> Column:
        # a blank goes first, for a mark of byte order at the front would be lost
        held = F.concat(F.encode(F.lit(" "), "UTF-32"), F.substring(wide, begin * 4 + 1, (end - begin) * 4))
        return F.substring(F.decode(held, "UTF-32"), F.lit(2), end - begin)

    def pieces(wide: Column, ordered: Column, reach: Column) -> Column:
        def piece(s: Column, i: Column) -> Column:
            at = F.coalesce(F.get(reach, i - 1), F.lit(0))
            return F.when(s["start"] >= at, F.concat(between(wide, at, s["start"]), F.lit(mark))).otherwise("")

        last = F.get(reach, F.size(reach) - 1)
        rest = between(wide, last, (F.length(wide) / 4).cast("int"))
        return F.concat(F.array_join(F.transform(ordered, piece), ""), rest)

    cut = let(
        F.encode(text, "UTF-32"),
        lambda wide: let(
            spans, lambda s: let(_maxima(s["end"]), lambda reach: pieces(wide, s, reach))
        ),
    )
    return F.when(F.size(spans) == 0, text).otherwise(cut)
