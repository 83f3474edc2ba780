"""The source audit against its SQL on odd rows, and transducers against plain dictionaries."""

import random

import duckdb
import numpy as np
import pytest

from menumix.llm import source_audit as A
from menumix.llm import transducer as T


def right_languages(terms):
    """Number of different sets of endings, which a minimal automaton has states for."""
    prefixes = {t[:i] for t in terms for i in range(len(t) + 1)}
    return len({frozenset(t[len(p):] for t in terms if t.startswith(p)) for p in prefixes})


@pytest.mark.parametrize("size, letters, longest", [(1, "a", 1), (40, "ab", 6), (400, "abé", 5), (60, "xyz", 12)])
def test_transducer_is_minimal_and_gives_ordinals(size, letters, longest):
    draw = random.Random(size)
    terms = sorted({"".join(draw.choice(letters) for _ in range(draw.randrange(1, longest + 1))).encode() for _ in range(size)})
    arrays = T.build(terms)
    assert len(arrays[3]) == right_languages(terms)
    held = T.Transducer(arrays, max(map(len, terms)))
    asked = terms + [t + b"a" for t in terms] + [t[:-1] for t in terms] + [b"q", b"\xff"]
    data = np.frombuffer(b"".join(asked), np.uint8)
    ends = np.cumsum([len(t) for t in asked])
    got = held.ordinals(data, ends - [len(t) for t in asked], ends)
    place = {t: i for i, t in enumerate(terms)}
    assert got.tolist() == [place.get(t, -1) for t in asked]
    assert [held.term(i) for i in range(len(terms))] == terms


SCHEMA = "lang string, source string, text string, term string, n int, ord long, total long, block long"


def odd_rows():
    draw = random.Random(11)
    rows = []
    for lang, words in (("en", 60), ("fr", 25), ("", 12), (None, 12), ("é", 5)):
        for i in range(90):
            text = "".join(f"{draw.choice(['Wort', 'été', 'x', '日本', 'MIX', 'don’t', 'a'])}{'éab'[draw.randrange(3)] * draw.randrange(words // 4 + 1)}{draw.choice([' ', '1', '_', chr(10), '-', chr(127)])}"
                           for _ in range(draw.randrange(0, 30)))
            rows.append((lang, draw.choice(["a", "b", "B", "é", None, "", "hot", "hot", "hot"]), text))
    rows += [("en", "only null", None), ("en", "empty", ""), ("few", "a", "too few documents"), ("few", "b", "x"), ("alone", "a", "x")]
    rows += [("en", "long", "mix " * 200000)] + [("rep", "s", "same words Same")] * 40 + [("rep", "t", None)]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard, block, least", [(1 << 16, 512, 50), (4, 3, 2)])
def test_odd_documents_equal_the_sql(spark, shard, block, least, monkeypatch):
    for name, value in (("SHARD_TERMS", shard), ("BLOCK", block), ("MOST_TERMS", least)):
        monkeypatch.setattr(A, name, value)
    rows = odd_rows()
    got = A.audit(spark.createDataFrame([(*r, "t", 1, 2, 3, 4) for r in rows], SCHEMA).repartition(4))
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (lang VARCHAR, source VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    want = con.execute(A.SQL.replace("rank <= 50", f"rank <= {least}")).fetchall()
    assert len(want) > 50
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_weights_are_exact_beyond_64_bits(spark):
    n, total, v = 7 * 10**12 + 3, 9 * 10**15 + 1, 10**8 + 7
    df = spark.createDataFrame([(n, total, v), (0, 0, 0), (0, 0, 1)], "n long, total long, v long")
    got = [r[0] for r in df.select(A.weight(df.n, df.total, df.v)).collect()]
    assert got == [1 + 10**9 * (n + 5) // (total + 5 * v), 0, 1 + 10**9 * 5 // 5]


def test_no_documents(spark):
    assert A.audit(spark.createDataFrame([], "lang string, source string, text string")).count() == 0
