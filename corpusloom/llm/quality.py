"""Quality rules whose cutoffs are proven on labelled documents.

Each rule rejects documents whose measure lies above a cutoff. Every stratum (language)
has a path on which the rules are tightened one cutoff of a fixed grid at a time, mild
before strict. One clean document in ``CHOOSING`` and all bad ones settle the path; the
other clean ones prove how far it may be walked. A place on it is proven if the exact
binomial tail shows that the rules together, as they stand there, reject more than
``risk`` of the clean texts with a probability of at most the level. Copies are no
independent trials, so equal texts of a stratum count once, and so do those of the pool. What is rejected
only grows along the path, so it is one fixed sequence of tests that stops at the first
failure, and needs no correction within. The level is ``error`` by the number of strata
with enough labels to be tested at all and the pool.

The pool of all labelled documents has a path of its own. Strata with too few clean
documents to prove anything, unlabelled ones too, use its cutoffs. These bound the false
rejection in the pool, not in each such stratum, and are named in the verdict.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import WHITE_CHARS, let, words
from corpusloom.workspace import materialize

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5

# Cutoffs under test, by rule; a document is rejected if its measure is larger.
GRIDS = {
    "symbol_share": [0.01, 0.02, 0.03, 0.05, 0.08, 0.12, 0.2, 0.3],
    "dup_line_share": [0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.7],
    "repeat_share": [0.02, 0.04, 0.06, 0.08, 0.1, 0.12, 0.15, 0.18],
    "word_length": [6.0, 7.0, 8.0, 9.0, 10.0, 12.0, 16.0, 24.0],
}
RISK = 0.02
ERROR = 0.05
CHOOSING = 5
POOLED = "(pooled)"
MAX_BROADCAST = 500_000
# The steps of a path by number: rule by rule, mild before strict.
STEPS = [(rule, float(cutoff)) for rule, grid in GRIDS.items() for cutoff in sorted(grid, reverse=True)]


def measure(docs: DataFrame) -> DataFrame:
    """``(doc_id, stratum, n_words, word_chars, n_symbols, n_dup_lines, n_lines,
    n_repeat_words, base_failed, text_key)``. A null text has no words, a null language
    is a stratum of its own. ``text_key`` tells equal texts."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("")) if "lang" in docs.columns else F.lit("")
    # no language can take the name of the pool
    stratum = F.when(F.startswith(lang, F.lit("(")), F.concat(F.lit("("), lang)).otherwise(lang)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), stratum.alias("stratum"), text.alias("text")
    )
    text = F.col("text")
    counted = let(
        words(text),
        lambda w: F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            let(_windows(w), _covered).alias("n_repeat_words"),
        ),
    )
    lined = let(
        F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
        lambda lines: F.struct(
            F.size(lines).cast("bigint").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
        ),
    )
    found = rows.select(
        "doc_id",
        "stratum",
        counted.alias("counted"),
        lined.alias("lined"),
        F.length(F.translate(text, WHITE_CHARS, "")).cast("bigint").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        F.sha2(text, 256).alias("text_key"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return found.select(
        "doc_id", "stratum", "counted.*", "lined.*", "word_chars", "n_symbols", "text_key"
    ).withColumn("base_failed", failed)


def _windows(w: Column) -> Column:
    """A 64-bit hash of each window of five words."""
    keys = F.transform(
        F.sequence(F.lit(0), F.size(w) - WINDOW),
        lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(WINDOW)]),
    )
    return F.when(F.size(w) >= WINDOW, keys).otherwise(F.array().cast("array<bigint>"))


def _covered(keys: Column) -> Column:
    """Words in windows whose key occurs twice or more: sorted by key, such windows
    are neighbours; sorted by place, each adds the words the last one left out."""

    def places(ordered: Column) -> Column:
        marked = F.transform(
            ordered,
            lambda e, j: F.when(
                e["key"].eqNullSafe(F.get(ordered, j - 1)["key"])
                | e["key"].eqNullSafe(F.get(ordered, j + 1)["key"]),
                e["place"],
            ),
        )
        return F.sort_array(F.filter(marked, lambda p: p.isNotNull()))

    ordered = F.sort_array(
        F.transform(keys, lambda key, i: F.struct(key.alias("key"), i.alias("place")))
    )
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("bigint").alias("words"))
    total = F.aggregate(
        let(ordered, places),
        start,
        lambda a, p: F.struct(
            p.alias("last"), (a["words"] + F.least(F.lit(WINDOW), p - a["last"])).alias("words")
        ),
        lambda a: a["words"],
    )
    once = F.size(F.array_distinct(keys)) == F.size(keys)
    return F.when(once, F.lit(0).cast("bigint")).otherwise(total)


def shares() -> dict[str, Column]:
    """The measure of each rule, by the counts of :func:`measure`."""

    def share(part: str, whole: str) -> Column:
        return F.col(part) / F.greatest(F.col(whole), F.lit(1))

    return {
        "symbol_share": share("n_symbols", "word_chars"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "word_length": share("word_chars", "n_words"),
    }


def binomial_tail(n: Column, k: Column, risk: float) -> Column:
    """P(Binomial(n, risk) <= k), summed exactly in logarithms from i = 0 to k."""
    odds = F.lit(risk / (1 - risk))
    first = n * F.log(F.lit(1 - risk))
    start = F.struct(first.alias("term"), first.alias("total"))

    def add(a: Column, i: Column) -> Column:
        term = a["term"] + F.log((n - i + 1) / i * odds)
        top = F.greatest(term, a["total"])
        total = top + F.log(F.exp(term - top) + F.exp(a["total"] - top))
        return F.struct(term.alias("term"), total.alias("total"))

    steps = F.when(k >= 1, F.sequence(F.lit(1).cast("bigint"), k)).otherwise(
        F.array().cast("array<bigint>")
    )
    return F.aggregate(steps, start, add, lambda a: F.exp(a["total"]))


def _cells(measured: DataFrame, labels: DataFrame) -> DataFrame:
    """``(stratum, part, over, n)``: distinct labelled texts past the base rules, by the
    steps they exceed, of every stratum and of the pool."""
    judged = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").alias("quality"))
        .filter(F.col("quality").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
        .filter(F.col("quality") == F.col("most"))
        .select("doc_id", "quality")
    )
    held_out = measured.filter(~F.col("base_failed")).join(judged, "doc_id")
    value = shares()
    over = [F.when(value[rule] > F.lit(cutoff), F.lit(i)) for i, (rule, cutoff) in enumerate(STEPS)]
    least, most = F.min("quality").alias("quality"), F.max("most").alias("most")
    stepped = held_out.select(
        "stratum",
        "text_key",
        "quality",
        F.col("quality").alias("most"),
        F.array_compact(F.array(*over)).alias("over"),
    )
    own = materialize(stepped.groupBy("stratum", "text_key", "over").agg(least, most), "labelled-texts")
    pool = own.groupBy("text_key", "over").agg(least, most)
    texts = own.unionByName(pool.withColumn("stratum", F.lit(POOLED)))
    choosing = F.pmod(F.xxhash64("text_key"), F.lit(CHOOSING)) == 0
    part = F.when(F.col("quality") == 0, "bad").when(choosing, "choose").otherwise("prove")
    agreed = texts.filter(F.col("quality") == F.col("most"))
    return agreed.groupBy("stratum", part.alias("part"), "over").agg(F.count("*").alias("n"))


def _paths(cells: DataFrame) -> DataFrame:
    """``(stratum, path)``: the steps that reject bad documents, those that cost the fewest
    clean ones of the choosing part first, of equals those of the rule that rejects most."""

    def number(part: str) -> Column:
        return F.sum(F.when(F.col("part") == part, F.col("n")).otherwise(0))

    rule_of = F.array(*[F.lit(list(GRIDS).index(rule)) for rule, _ in STEPS])
    steps = (
        cells.filter(F.col("part") != "prove")
        .select("stratum", "part", "n", F.explode("over").alias("step"))
        .groupBy("stratum", "step")
        .agg(number("bad").alias("bad"), number("choose").alias("cost"))
        .filter("bad > 0")
        .withColumn("rule", F.get(rule_of, F.col("step")))
    )
    peaks = steps.groupBy("stratum", "rule", "cost").agg(
        (-F.max("bad")).alias("peak"), F.collect_list("step").alias("steps")
    )
    ordered = peaks.select(
        "stratum", F.explode("steps").alias("step"), F.struct("cost", "peak").alias("key")
    )
    path = F.sort_array(F.collect_list(F.struct("key", "step")))["step"]
    found = ordered.groupBy("stratum").agg(path.alias("path"))
    # steps that reject no further bad document are not taken
    useful = (
        cells.filter(F.col("part") == "bad")
        .join(found, "stratum")
        .groupBy("stratum", "path")
        .agg(F.collect_set(_first("over", "path")).alias("useful"))
    )
    return useful.select(
        "stratum", F.filter("path", lambda s, i: F.array_contains("useful", i + 1)).alias("path")
    )


def _first(over: str, path: str) -> Column:
    """The first place of a path, from 1, whose step is exceeded; null for none."""
    places = F.transform(over, lambda s: F.array_position(path, s))
    return F.array_min(F.filter(places, lambda p: p > 0)).cast("int")


def cutoffs(
    measured: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR
) -> DataFrame:
    """``(stratum, n_clean, symbol_share, ...)``: the cutoff of each rule, null where none
    is proven, for every stratum with enough clean documents for a proof and for the pool,
    ``(pooled)``. ``n_clean`` are the texts the proof rests on. A language that begins with
    ``(`` has one more in the name of its stratum.

    Labels without a document, documents and equal texts with contradicting labels and
    labels other than 0 and 1 prove nothing and are passed over.
    """
    cells = materialize(_cells(measured, labels), "all-cells")
    paths = materialize(_paths(cells), "paths")
    proving = cells.filter(F.col("part") == "prove")
    clean = materialize(proving.groupBy("stratum").agg(F.sum("n").alias("n_clean")), "clean")

    def least(level: float) -> int:
        """Clean documents that prove something if none of them is rejected."""
        return math.ceil(math.log(level) / math.log(1 - risk))

    strata = clean.filter((F.col("n_clean") >= least(error)) & (F.col("stratum") != POOLED)).count()
    level = error / (strata + 1)
    tested = clean.filter(F.col("n_clean") >= least(level))
    hits = (
        proving.join(paths, "stratum")
        .select("stratum", _first("over", "path").alias("at"), "n")
        .groupBy("stratum", "at")
        .agg(F.sum("n").alias("n"))
        .filter("at is not null")
        .groupBy("stratum")
        .agg(F.collect_list(F.struct("at", "n")).alias("hits"))
    )
    walked = tested.join(paths, "stratum", "left").join(hits, "stratum", "left")
    none = F.array().cast("array<struct<at:int,n:bigint>>")
    walked = walked.select(
        "stratum",
        "n_clean",
        F.coalesce("path", F.array().cast("array<int>")).alias("path"),
        F.coalesce("hits", none).alias("hits"),
    )

    def proven(step: Column, i: Column) -> Column:
        rejected = F.aggregate(
            F.filter("hits", lambda h: h["at"] <= i + 1),
            F.lit(0).cast("bigint"),
            lambda a, h: a + h["n"],
        )
        # more rejections than expected at that risk can never prove it
        return let(
            rejected,
            lambda k: F.when(
                k <= F.col("n_clean") * risk, binomial_tail(F.col("n_clean"), k, risk) <= level
            ).otherwise(False),
        )

    walked = walked.select("stratum", "n_clean", F.filter("path", proven).alias("taken"))

    def strictest(rule: str) -> Column:
        own = [F.lit(cutoff if name == rule else None).cast("double") for name, cutoff in STEPS]
        return F.array_min(F.transform("taken", lambda s: F.get(F.array(*own), s)))

    return walked.select("stratum", "n_clean", *[strictest(rule).alias(rule) for rule in GRIDS])


def quality_verdicts(
    docs: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR
) -> DataFrame:
    """``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, rejected_by)``, one row for each document.

    ``kept`` is false for a document that fails a base rule or exceeds a proven cutoff
    of its stratum; ``rejected_by`` names the first such rule, '' for none, and adds
    ``(pooled)`` if the cutoff is that of the pool, in strata too small for a proof. Without
    labels only the base rules reject. A null or empty text has no words and fails.
    Repeated rows are judged one by one, but count once in a proof, as do all equal texts.
    An empty table gives no rows.
    """
    measured = materialize(measure(docs), "quality")
    found = materialize(cutoffs(measured, labels, risk, error), "cutoffs")
    rules = found.filter(F.col("stratum") != POOLED).select(
        "stratum", F.lit(True).alias("own"), *[F.col(r).alias(f"cut_{r}") for r in GRIDS]
    )
    if rules.count() <= MAX_BROADCAST:  # beyond that the join shuffles
        rules = F.broadcast(rules)
    pool = found.filter(F.col("stratum") == POOLED).agg(*[F.max(r).alias(f"pool_{r}") for r in GRIDS])
    judged = measured.join(rules, "stratum", "left").crossJoin(F.broadcast(pool))
    reason = F.when(F.col("base_failed"), F.lit("base"))
    for rule, value in shares().items():
        reason = reason.when(F.col("own") & (value > F.col(f"cut_{rule}")), F.lit(rule))
    for rule, value in shares().items():
        over = F.col("own").isNull() & (value > F.col(f"pool_{rule}"))
        reason = reason.when(over, F.lit(f"{rule} {POOLED}"))
    return judged.withColumn("rejected_by", reason.otherwise(F.lit(""))).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (F.col("rejected_by") == "").alias("kept"),
        "rejected_by",
    )
