"""Toxicity scores against a plain version, and held-out accuracy."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from menumix.llm import toxicity as T

BAD = ["moron", "idiot", "worthless"]


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(13)
    rows = []
    for i in range(1500):
        words = [f"w{min(int(draw.expovariate(0.02)), 400)}" for _ in range(draw.randrange(5, 80))]
        toxic = int(i % 5 == 0)
        for _ in range(2 if toxic else 0):
            words.insert(draw.randrange(len(words)), draw.choice(BAD).upper() + draw.choice([",", ".", ""]))
        rows.append((i, " ".join(words), toxic))
    return rows + [(1500, None, 0), (1501, "", None), (1502, " \n\t", 0), (1503, "é 日本 😀", 0), (1504, "w1 " * 200000 + "moron idiot", 1)]


@pytest.fixture(scope="module")
def tables(spark, corpus):
    docs = spark.createDataFrame([(i, t, 1, "y", 0.5, 3, "x") for i, t, _ in corpus], "doc_id long, text string, id long, _text string, score double, _y int, x string").repartition(3)
    labels = spark.createDataFrame([(i, y) for i, _, y in corpus], "doc_id long, toxic int").where("doc_id % 5 <> 1 and doc_id % 10 <> 0")
    return docs, labels


@pytest.fixture(scope="module")
def weights(tables):
    return T.fit(*tables)


def plain_score(weights, text):
    words, here = [], bytearray()
    for b in (text or "").encode() + b" ":
        if 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128:
            here.append(b + 32 if 65 <= b <= 90 else b)
        elif here:
            words.append(bytes(here).decode())
            here = bytearray()
    def buckets(run):  # of the terms that hold all words of the run, from the operator's own hashes
        return T.terms(pa.array([" ".join(run)]))[1]
    found = set()
    if words:
        found |= {int(buckets([w])[0]) for w in set(words)}
        found |= {int(buckets(p)[2]) for p in set(zip(words, words[1:]))}
        # Beyond pairs the order of the list is: words, neighbours, one word left out, two left out.
        found |= {int(buckets(p)[5]) for p in set(zip(words, words[1:], words[2:]))}
        found |= {int(buckets(p)[9]) for p in set(zip(words, words[1:], words[2:], words[3:]))}
    table = dict(zip(weights.buckets.tolist(), weights.values.tolist()))
    return 1 / (1 + math.exp(-weights.bias - sum(float(np.float32(table.get(b, 0.0))) for b in found)))


def test_scores_equal_the_plain_version(tables, corpus, weights):
    got = {r.id: r.score for r in T.score(tables[0], weights).collect()}
    assert set(got) == {i for i, *_ in corpus}
    for i, text, _ in corpus[::60] + corpus[-5:]:
        assert got[i] == pytest.approx(plain_score(weights, text), abs=1e-6)
    assert got[1500] == got[1501] == got[1502]


def test_held_out_accuracy_and_sparsity(tables, corpus, weights):
    got = {r.id: r.score for r in T.score(tables[0], weights).collect()}
    held = [(i, y) for i, _, y in corpus[:1500] if i % 10 == 0 or i % 5 == 1]
    assert np.mean([(got[i] >= 0.5) == y for i, y in held]) > 0.97
    assert got[1504] > 0.5 and 0 < len(weights.buckets) < 500


def test_training_is_repeatable(tables, weights):
    again = T.fit(tables[0].repartition(5), tables[1].repartition(2))
    assert again.bias == weights.bias and (again.values == weights.values).all()


def test_bound_counts_texts_of_a_repeated_id(spark, monkeypatch):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(500)] + [(2, "other"), (None, "none")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, 1), (None, 1), (4, 7)], "doc_id long, toxic int")
    seen = []
    monkeypatch.setattr(T, "train", lambda rows, y: seen.append(len(y)))
    T.fit(docs, labels, most_rows=10)
    assert seen == [10]


def test_without_labels_or_rows(spark, tables):
    docs, labels = tables
    assert T.fit(docs, labels.where(F.lit(False))) is None
    assert {r.score for r in T.score(docs, None).collect()} == {0.5}
    assert T.score(docs.where("doc_id < 0"), T.fit(docs, labels)).count() == 0
