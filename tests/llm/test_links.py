"""How many pairs the search for links makes, and that it finds all of them."""

from __future__ import annotations


import pytest

from menumix.llm import links, near_dedup


@pytest.fixture
def met(monkeypatch):
    """The numbers of pairs that meet in the searches of a test."""
    counts, meet = [], links.Search.meet

    def counted(self, pairs, *rest):
        counts.append(pairs.distinct().count())
        return meet(self, pairs, *rest)

    monkeypatch.setattr(links.Search, "meet", counted)
    return counts


def test_texts_that_share_too_little_make_no_pairs(spark, met):
    """Half of each text is its own, so no two are similar, however many values of the other half all have."""
    rows = [(i, " ".join([f"all{w}" for w in range(60)] + [f"own{i}_{w}" for w in range(60)])) for i in range(60)]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), n_words=2).collect()
    assert {r.component_id for r in got} == set(range(60))
    assert sum(met) == 0


def test_ids_shared_by_two_texts(spark):
    """Both texts of one id are documents of their own and keep their links."""
    base, other = ([f"{name}{w}" for w in range(60)] for name in "ab")
    rows = [(1, " ".join(base)), (1, " ".join(other)), (2, " ".join([*base[:59], "x"])), (3, " ".join([*other[:59], "y"]))]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), n_words=2).collect()
    assert sorted((r.id, r.component_id, r.kept) for r in got) == [(1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False)]
