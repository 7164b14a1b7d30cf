"""The pipeline against a brute-force version of each stage, with labels that prove a
cutoff, so that every row of every stage is known."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from corpusloom.llm.bpe import default_vocabulary

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SECRET = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{12,}""")
SYMBOLS = re.compile(r"[#*$%&|<>]")


def _corpus():
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdefghijklm") for _ in range(6)) for _ in range(3000)]

    def prose(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    texts = [(" ".join(prose(30)), 1) for _ in range(700)]
    texts += [(" ".join(prose(25)) + " ####%%%% $$$$&&&& ||||<<<< >>>>****", 0) for _ in range(20)]
    texts += [(" ".join(prose(25)) + " ####%%%% $$$$&&&& ||||<<<< >>>>****", None) for _ in range(10)]
    texts += [(" ".join(prose(n)), None) for n in (1, 5, 9, 10)] + [(None, None), ("", None)]
    texts += [(" ".join(prose(7) * 3), None), (" ".join(prose(12)) + "\n" + "one line again and again " * 9, None)]
    copied = [" ".join(prose(60)) for _ in range(5)]
    texts += [(t, None) for t in copied for _ in range(4)]
    for _ in range(6):
        base = prose(80)
        for place in (0, 20, 79):
            texts.append((" ".join([*base[:place], "changed", *base[place + 1 :]]), None))
    texts += [(" ".join(prose(20)) + f" PassWord: {'x' * 14}{i} " + " ".join(prose(5)), None) for i in range(5)]
    texts += [(" ".join(prose(4000)), None)]
    order = list(range(len(texts)))
    rng.shuffle(order)
    rows = [(i * 7 + 2**55 + 1, text) for i, (text, _) in zip(order, texts, strict=True)]
    labels = [(i, q, 0) for (i, _), (_, q) in zip(rows, texts, strict=True) if q is not None]
    return [*rows, (None, " ".join(prose(40)))], labels


ROWS, LABELS = _corpus()


def _passes(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    repeated = {i + j for i, w in enumerate(windows) if times[w] > 1 for j in range(5)}
    base_failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
    return not base_failed and not len(SYMBOLS.findall(text)) > 0.1 * sum(map(len, words))


def _one_of_equals(rows):
    largest = {}
    for doc_id, text in rows:
        if doc_id is not None:
            largest[text] = max(largest.get(text, doc_id), doc_id)
    return [r for r in rows if r[0] is None or largest[r[1]] == r[0]]


def _one_of_near(rows):
    sets = {}
    for doc_id, text in rows:
        words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
        sets[doc_id] = {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))}
    first = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if None not in (a, b) and a < b:
                both = len(sets[a] & sets[b])
                if 100 * both >= 80 * len(sets[a] | sets[b]):
                    low, high = sorted((first[a], first[b]))
                    first = {i: low if f == high else f for i, f in first.items()}
    return [r for r in rows if first[r[0]] == r[0]]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    rows = [(i, t, "en", "s", len(t or "")) for i, t in ROWS]
    schema = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = spark.createDataFrame(LABELS, "doc_id BIGINT, quality INT, toxic INT")
    labels.write.parquet(f"{path}/labels.parquet")
    return path


def test_every_stage_equals_brute_force(spark, folder):
    wanted, docs = list(ROWS), spark.read.parquet(f"{folder}/documents.parquet")
    by_hand = {
        "quality_rules": lambda rows: [r for r in rows if _passes(r[1])],
        "exact_dedup": _one_of_equals,
        "jaccard_join": _one_of_near,
        "secret_scan": lambda rows: [(i, SECRET.sub("[secret]", t)) for i, t in rows],
    }
    for name, stage in corpus_pipeline.STAGES[:-1]:
        wanted = by_hand[name](wanted)
        docs = corpus_pipeline.materialize(stage(spark, docs, folder), name)
        found = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=str)
        assert found == sorted(wanted, key=str), name
        counts = {r["doc_id"]: (r["n_chars"], len(r["text"])) for r in docs.collect()}
        assert {i: n for i, n in counts.items() if n[0] != n[1]} == {}, name
    _is_packing_of(corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect(), wanted)
    _is_packing_of(corpus_pipeline.run(spark, folder).collect(), wanted)


def _is_packing_of(pieces, rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(default_vocabulary())
    held, covered = defaultdict(list), defaultdict(list)
    ids = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 0] for i, t in rows}
    for p in pieces:
        part = ids[p["doc_id"]][p["start"] : p["start"] + p["length"]]
        assert p["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
        assert p["doc_tokens"] == len(ids[p["doc_id"]])
        covered[p["doc_id"]].append((p["start"], p["length"]))
        held[p["sequence_id"]].append((p["offset"], p["length"]))
    assert set(covered) == set(ids)
    for places, size in [(covered[i], len(x)) for i, x in ids.items()] + [(s, None) for s in held.values()]:
        end = 0
        for start, length in sorted(places):
            assert start == end
            end += length
        assert end == size if size is not None else end <= 1024
