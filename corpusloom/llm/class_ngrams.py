"""Perplexity under a class-based bigram model, after Brown.

P(word | before) = P(class | class before) * P(word | class). The most frequent words are
put into classes by exchange: each moves to the class that raises the likelihood of the
classes around it most. All other words share one class, from which unseen words get
their probability by absolute discounting; the end of a text is a class of its own.
Transitions are smoothed with the frequency of the class.

Every round counts, over all training texts, how often each clustered word stands next
to each class. The counts are a matrix of fixed size, summed on the executors; moving
the words is arithmetic on that matrix. Counts of all other words stay distributed, and
the words of texts are joined to them.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import exact_ids, id_and_text, ship_package, whole_ids
from corpusloom.workspace import materialize

FOLDS, HELD_OUT = 5, 1
# Size of the model, whatever the corpus: clustered words, their classes, rounds.
CLUSTERED = 16_384
CLASSES = 64
ROUNDS = 3
SMOOTHING = 50.0
PIECES = 16
FLUSH_WORDS = 400_000


def tokens(text: str) -> list[bytes]:
    """Words between ASCII white space, lower-cased ASCII-wise."""
    return text.encode("utf-8").lower().split()


def split_rows(docs: DataFrame) -> DataFrame:
    """``(doc_id, text, held_out)``; a row without an identifier is for training."""
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS
    return id_and_text(docs).withColumn("held_out", fold == HELD_OUT)


def count_words(training: DataFrame) -> DataFrame:
    """``(word, c)`` over all texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter[bytes] = Counter()

        def flushed() -> pd.DataFrame:
            words = [w.decode("utf-8") for w in counts]
            frame = pd.DataFrame({"word": pd.Series(words, dtype=object), "n": list(counts.values())})
            counts.clear()
            return frame

        for batch in batches:
            for text in batch["text"]:
                counts.update(tokens(text))
                if len(counts) > FLUSH_WORDS:
                    yield flushed()
        yield flushed()

    found = training.select("text").mapInPandas(run, "word STRING, n BIGINT")
    return found.groupBy("word").agg(F.sum("n").alias("c"))


class Coder:
    """Classes of a text's tokens. ``ids`` numbers the clustered words; the two numbers
    after them stand for any other word and for the end."""

    def __init__(self, words: list[str], classes: np.ndarray) -> None:
        self.ids = {w.encode("utf-8"): i for i, w in enumerate(words)}
        self.other, self.end = len(words), len(words) + 1
        self.classes = classes

    def code(self, found: list[bytes]) -> np.ndarray:
        """The number of each token; the end stands before and behind the words."""
        get, other = self.ids.get, self.other
        ids = np.full(len(found) + 2, self.end, "i4")
        ids[1:-1] = np.fromiter((get(w, other) for w in found), "i4", len(found))
        return ids


def _summed(training: DataFrame, coder: Coder, count, shape: tuple[int, ...]) -> np.ndarray:
    """The sum over all texts of ``count(ids, classes)``, whose cells are numbered; the
    tasks' tables of this fixed size meet piece by piece."""
    shared = training.sparkSession.sparkContext.broadcast(coder)
    size = int(np.prod(shape))
    width = -(-size // PIECES)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = shared.value
        table = np.zeros(PIECES * width, "i8")
        for batch in batches:
            for i in range(0, len(batch), 512):
                texts = batch["text"].iloc[i : i + 512]
                coded = [coder.code(tokens(t)) for t in texts]
                cells = [count(ids, coder.classes[ids]) for ids in coded]
                table += np.bincount(np.concatenate(cells), minlength=len(table))
        for piece, part in enumerate(np.split(table, PIECES)):
            if part.any():
                packed = zlib.compress(part.astype("<i8").tobytes(), 1)
                yield pd.DataFrame([(piece, packed)], columns=["piece", "counts"])

    def add(key: tuple, held: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(width, "i8")
        for x in held["counts"]:
            total += np.frombuffer(zlib.decompress(x), "<i8")
        packed = zlib.compress(total.astype("<i8").tobytes(), 1)
        return pd.DataFrame([(key[0], packed)], columns=["piece", "counts"])

    schema = "piece INT, counts BINARY"
    parts = training.select("text").mapInPandas(run, schema)
    table = np.zeros((PIECES, width), "i8")
    for row in parts.groupBy("piece").applyInPandas(add, schema).collect():
        table[row["piece"]] = np.frombuffer(zlib.decompress(row["counts"]), "<i8")
    return table.reshape(-1)[:size].reshape(shape)


def _phi(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(left: np.ndarray, right: np.ndarray, classes: np.ndarray, n_classes: int) -> np.ndarray:
    """One sweep over the words, the most frequent first. Row w of ``left`` and ``right``
    has how often word w follows and precedes each class; each word is taken out of its
    class and put where the likelihood of its neighbours' classes grows most."""
    classes = classes.copy()
    sides = []
    for counts in (left, right):
        table = np.zeros((n_classes, counts.shape[1]))
        np.add.at(table, classes, counts)
        sides.append((counts, table))
    sizes = np.bincount(classes, weights=left.sum(axis=1), minlength=n_classes)
    for w in range(len(classes)):
        old, n = classes[w], left[w].sum()
        sizes[old] -= n
        gain = 2 * (_phi(sizes) - _phi(sizes + n))
        for counts, table in sides:
            near = np.flatnonzero(counts[w])
            added = counts[w, near]
            table[old, near] -= added
            held = table[:, near]
            gain += (_phi(held + added) - _phi(held)).sum(axis=1)
        best = int(gain.argmax())
        classes[w] = best
        sizes[best] += n
        for counts, table in sides:
            table[best] += counts[w]
    return classes


@dataclass(frozen=True)
class ClassModel:
    """A trained model. ``vocabulary`` has the counts of all words; the rest is of fixed
    size."""

    vocabulary: DataFrame
    coder: Coder
    counts: np.ndarray
    transitions: np.ndarray
    n_tokens: int
    n_words: int
    n_other: int
    n_other_words: int
    discount: float

    def log_transitions(self) -> np.ndarray:
        """log10 P(class | class before)."""
        total = self.transitions.sum()
        share = (self.transitions.sum(axis=0) + 0.5) / (total + 0.5 * len(self.transitions))
        rows = self.transitions.sum(axis=1, keepdims=True)
        return np.log10((self.transitions + SMOOTHING * share) / (rows + SMOOTHING))

    def log_emissions(self) -> np.ndarray:
        """log10 P(word | class) of the clustered words, 0 for the two numbers after."""
        found = np.zeros(len(self.counts) + 2)
        classes = self.coder.classes[: len(self.counts)]
        if len(classes):
            sums = np.bincount(classes, weights=self.counts)
            found[:-2] = np.log10(self.counts / sums[classes])
        return found


def train(
    training: DataFrame,
    clustered: int = CLUSTERED,
    n_classes: int = CLASSES,
    rounds: int = ROUNDS,
) -> ClassModel:
    """Fit the model to all texts of ``training``."""
    n_docs = training.count()
    vocabulary = materialize(count_words(training), "vocabulary")
    top = vocabulary.orderBy(F.col("c").desc(), "word").limit(clustered).collect()
    words, counts = [r["word"] for r in top], np.array([r["c"] for r in top], "f8")
    sums = vocabulary.agg(
        F.count("*").alias("words"),
        F.coalesce(F.sum("c"), F.lit(0)).alias("tokens"),
        F.count(F.when(F.col("c") == 1, 1)).alias("once"),
        F.count(F.when(F.col("c") == 2, 1)).alias("twice"),
    ).first()
    # one class for other words, one for the end
    classes = np.r_[np.arange(len(words)) % n_classes, n_classes, n_classes + 1].astype("i8")
    wide = n_classes + 2
    for _ in range(rounds if words else 0):
        coder = Coder(words, classes)
        shape = (2, len(words) + 2, wide)
        beyond = shape[1] * wide

        def beside(ids: np.ndarray, of: np.ndarray, wide=wide, beyond=beyond) -> np.ndarray:
            follows = ids[1:].astype("i8") * wide + of[:-1]
            precedes = beyond + ids[:-1].astype("i8") * wide + of[1:]
            return np.concatenate([follows, precedes])

        left, right = _summed(training, coder, beside, shape).astype("f8")
        n = len(words)
        classes[:n] = exchange(left[:n], right[:n], classes[:n], n_classes)

    coder = Coder(words, classes)

    def follows(ids: np.ndarray, of: np.ndarray, wide=wide) -> np.ndarray:
        return of[:-1] * wide + of[1:]

    transitions = _summed(training, coder, follows, (wide, wide)).astype("f8")
    once, twice = sums["once"], sums["twice"]
    discount = min(max((once + 0.5) / (once + 2 * twice + 1), 0.05), 0.95)
    return ClassModel(
        vocabulary,
        coder,
        counts,
        transitions,
        sums["tokens"] + n_docs,
        sums["words"] + bool(n_docs),
        int(sums["tokens"] - counts.sum()),
        sums["words"] - len(words),
        discount,
    )


def _first_scores(rows: DataFrame, model: ClassModel) -> DataFrame:
    """Scores without the other words, which are listed with how often they occur."""
    context = rows.sparkSession.sparkContext
    base = np.log10(np.r_[model.counts, 0, 0] + 0.5)
    base[-1] = np.log10(model.transitions[:, -1].sum() + 0.5)
    shared = context.broadcast(
        (model.coder, model.log_transitions(), model.log_emissions(), base)
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder, transitions, emissions, base = shared.value
        number = TaskContext.get().taskAttemptId() << 32
        for batch in batches:
            found = []
            for text in batch["text"]:
                held = tokens(text)
                ids = coder.code(held)
                of = coder.classes[ids]
                own = ids != coder.other
                score = transitions[of[:-1], of[1:]].sum() + emissions[ids[1:]].sum()
                rest = Counter(held[i] for i in np.flatnonzero(~own[1:-1]))
                found.append(
                    (
                        number,
                        len(held) + 1,
                        int(own[1:].sum()),
                        float(score),
                        float(base[ids[1:][own[1:]]].sum()),
                        [w.decode("utf-8") for w in rest],
                        list(rest.values()),
                    )
                )
                number += 1
            names = ["row", "n_tokens", "n_own", "own_score", "own_base", "words", "times"]
            frame = pd.DataFrame(found, columns=names)
            frame["doc_id"] = whole_ids(batch["doc_id"])
            yield frame.assign(held_out=batch["held_out"].to_numpy())

    schema = (
        "row BIGINT, n_tokens BIGINT, n_own BIGINT, own_score DOUBLE, own_base DOUBLE, "
        "words ARRAY<STRING>, times ARRAY<BIGINT>, doc_id BIGINT, held_out BOOLEAN"
    )
    return exact_ids(rows).mapInPandas(run, schema)


def score(rows: DataFrame, model: ClassModel) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)``."""
    first = materialize(_first_scores(rows, model), "own-scores")
    listed = first.select("row", F.explode(F.arrays_zip("words", "times")).alias("w"))
    listed = listed.select("row", F.col("w.words").alias("word"), F.col("w.times").alias("n"))
    met = listed.join(model.vocabulary, "word", "left")
    c = F.col("c")
    # Unseen words share what the discount has taken from the seen ones by their spelling:
    # each byte, and the end behind the last, is one of 257. So all words together have
    # no more than their class.
    whole = float(max(model.n_other, 1))
    unseen = model.discount * model.n_other_words / whole if model.n_other else 1.0
    unseen = max(unseen, 0.5 / (whole + 1))
    spelled = (F.octet_length("word") + 1) * float(np.log10(257))
    emission = F.when(c.isNull(), float(np.log10(unseen)) - spelled).otherwise(
        F.log10((c - model.discount) / whole)
    )
    others = met.groupBy("row").agg(
        F.sum(F.when(c.isNotNull(), F.col("n")).otherwise(0)).alias("known"),
        F.sum(F.col("n") * emission).alias("score"),
        F.sum(F.col("n") * F.log10(F.coalesce(c, F.lit(0)) + 0.5)).alias("base"),
    )
    joined = first.drop("words", "times").join(others, "row", "left")
    norm = float(np.log10(model.n_tokens + 0.5 * (model.n_words + 1)))
    zero = F.lit(0.0)
    end_known = 1 if model.n_tokens else 0
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_own") - 1 + end_known + F.coalesce("known", F.lit(0))).cast("bigint").alias("n_known"),
        F.lit(model.n_tokens).cast("bigint").alias("train_tokens"),
        (F.col("own_base") + F.coalesce("base", zero) - F.col("n_tokens") * norm).alias("base_score"),
        (F.col("own_score") + F.coalesce("score", zero)).alias("score"),
    )


def class_bigram_scores(docs: DataFrame, **sizes: int) -> DataFrame:
    """Train on the documents outside the held-out fold and score all.

    A null or empty text is its end alone. Repeated rows count and are scored one by one,
    a row without an identifier is for training. Without training documents every word is
    unseen. An empty table gives no rows.
    """
    ship_package(docs.sparkSession)
    rows = split_rows(docs)
    return score(rows, train(rows.filter(~F.col("held_out")), **sizes))
