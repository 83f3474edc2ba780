"""Stages of the corpus pipeline one by one on odd rows, and the whole run."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from menumix.llm import quality

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _copies int, _nth int, node long, keep_id long, _hash long"


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(21)

    def sentence(n):
        return " ".join(f"w{draw.randrange(900)}" for _ in range(n))

    rows = [[i, sentence(draw.randrange(30, 90)), "en", f"s{i % 4}"] for i in range(150)]
    rows += [[200 + i, rows[i][1], "en", "copy"] for i in range(10)]
    for i in range(20, 30):  # one word of many differs
        words = rows[i][1].split() * 3
        rows.append([300 + i, " ".join(words), "en", "s0"])
        words[5] = "changed"
        rows.append([400 + i, " ".join(words), "en", "s1"])
    rows += [[500 + i, "!!! ### BUY 99 " * 9 + f"{i}" * 9, "en", "junk"] for i in range(40)]
    return rows + [[600, None, None, None], [601, "", "en", None], [602, " \n", "en", "s1"], [None, sentence(40), "en", "s2"], [5, rows[5][1], "en", "s1"], [7, sentence(50), "en", "s3"],
                   [603, "long " * 30000, "en", "s2"]]


@pytest.fixture(scope="module")
def folder(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame([(*r, 9, 1, 1, 2, 3, 4) for r in rows], SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(r[0], int(r[3] != "junk"), 0) for r in rows if r[0] is not None], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.fixture(scope="module")
def docs(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


def keys(df):
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=str)


def test_quality_stage_keeps_what_scores_enough(spark, docs, folder):
    kept = corpus_pipeline.reject_low_quality(spark, docs, folder)
    net = quality.learn_from_tables(spark, docs, folder)
    good = {r.id for r in quality.score(docs.where("doc_id is not null"), net).where("score >= 0.7").collect()}
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} - {None} == good
    assert not [r for r in kept.collect() if r.source == "junk"] and len(good) > 140


def test_exact_stage_keeps_the_largest_id_of_equal_texts(spark, docs, rows, folder):
    kept = corpus_pipeline.drop_exact_duplicates(spark, docs, folder)
    best = {}
    for doc_id, text, *_ in rows:
        best[text or ""] = max(best.get(text or "", -1), -1 if doc_id is None else doc_id)
    assert kept.columns == docs.columns
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.text or "") for r in kept.collect()) == sorted((i, t) for t, i in best.items())


def test_near_stage_keeps_the_smallest_id_of_each_group(spark, docs, rows, folder):
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, folder)
    sets = {}
    for n, (doc_id, text, *_) in enumerate(rows):
        words = (text or "").split()
        sets[n] = {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())
    gone = []
    for n, (doc_id, text, *_) in enumerate(rows):
        for m, (other, *_) in enumerate(rows):
            if doc_id is not None and other is not None and other < doc_id and sets[n] and 5 * len(sets[n] & sets[m]) >= 4 * len(sets[n] | sets[m]):
                gone.append(n)
                break
    assert kept.columns == docs.columns and len(gone) > 15
    assert keys(kept) == sorted(((r[0], r[1]) for n, r in enumerate(rows) if n not in gone), key=str)


def test_mixture_stage_repeats_whole_rows(spark, docs, rows, folder):
    kept = corpus_pipeline.mix_sources(spark, docs, folder)
    assert kept.columns == docs.columns and keys(kept) == keys(corpus_pipeline.mix_sources(spark, docs.repartition(5), folder))
    held = {(r[0], r[1]) for r in rows}
    assert set(keys(kept)) <= held
    assert max(r["count"] for r in kept.where("doc_id < 400 and doc_id not in (5, 7)").groupBy("doc_id").count().collect()) <= 3


def test_encode_stage_gives_a_row_for_every_row(spark, docs, rows, folder):
    got = corpus_pipeline.encode(spark, docs, folder).collect()
    assert sorted((str(r.doc_id), r.decoded_sha256) for r in got) == sorted((str(r[0]), hashlib.sha256((r[1] or "").encode()).hexdigest()) for r in rows)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_of_no_documents(spark, docs, folder, name, stage):
    assert stage(spark, docs.where(F.lit(False)), folder).count() == 0


def test_run_equals_its_stages(spark, docs, rows, folder):
    got = corpus_pipeline.run(spark, folder)
    texts = {hashlib.sha256((r[1] or "").encode()).hexdigest() for r in rows if r[3] != "junk"}
    assert {r.decoded_sha256 for r in got.collect()} <= texts
    after = docs
    for _, stage in corpus_pipeline.STAGES:
        after = stage(spark, after, folder)
    assert sorted(map(str, got.collect())) == sorted(map(str, after.collect()))
