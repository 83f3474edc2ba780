"""Every operator against a plain version on rows with nulls, empty and long texts, ties, repeats and clashing columns."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from menumix.llm import bpe, exact_dedup, language_model, line_dedup, links, mixing, near_dedup, nearest, quality, substring_dedup, warc
from menumix.llm.words import words_of

SCHEMA = "doc_id long, text string, source string, id long, node long, n int, kept boolean, k string, size int, component long, _text string, _row string"


def sentence(draw, n):
    return " ".join(draw.choice(["the", "of", "and"]) if draw.random() < 0.3 else f"w{draw.randrange(4000)}" for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    """(doc_id, text, source) of a small corpus with copies, near copies and odd rows."""
    draw = random.Random(3)
    rows = []
    for i in range(60):
        rows.append((i, "\n".join(sentence(draw, draw.randrange(1, 60)) for _ in range(draw.randrange(1, 5))), f"s{i % 5}"))
    base = sentence(draw, 120).split()
    passage = sentence(draw, 60)
    for i in range(60, 90):  # near copies of one text, some beyond the threshold from each other
        words = list(base)
        for _ in range(draw.randrange(0, 14)):
            words[draw.randrange(len(words))] = f"x{draw.randrange(9999)}"
        rows.append((i, " ".join(words), "s0"))
    rows += [(i, f"{sentence(draw, 10)} {passage} {sentence(draw, 8)}", "s1") for i in range(90, 100)]
    rows += [(100, None, None), (101, "", None), (102, " \t\n ", "s2"), (103, "One", "s2"), (104, "one", "é"), (105, rows[3][1], "s3"), (106, rows[3][1], "s3"),
             (107, sentence(draw, 20000), "s4"), (108, "loop " * 90, "s4"), (109, "a b É é ñ\x1fx 日本 😀 's don't  \n\n\t end", "é"), (110, rows[3][1].upper(), "s3")]
    return rows


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(*r, 7, 8, 9, False, "k", 1, 2, "t", "r") for r in texts], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def odd(spark, docs):
    """The corpus with a repeated row and a row without id."""
    more = docs.where("doc_id = 5").unionAll(docs.where("doc_id = 6").withColumn("doc_id", F.lit(None).cast("long")))
    return docs.unionAll(more)


def words(text):
    return (text or "").encode().split()


def empty(docs):
    return docs.where("doc_id < 0")


def by_id(df, key="id"):
    return {r[key]: r for r in df.collect()}


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def similar_pairs(sets, share=80):
    index, out = defaultdict(list), []
    for d, s in sets.items():
        for v in s:
            index[v].append(d)
    for d, s in sets.items():
        hits = Counter(e for v in s for e in index[v] if e > d)
        out += [(d, e) for e, i in hits.items() if 100 * i >= share * (len(s) + len(sets[e]) - i)]
    return out


# --- 1 ---------------------------------------------------------------------------
def test_least_shared_keeps_its_promise():
    for k, share in ((64, 0.8), (32, 0.8), (64, 0.5)):
        c = near_dedup.least_shared(k, share)
        assert sum(math.comb(k, i) * share**i * (1 - share) ** (k - i) for i in range(c)) <= 1e-8


@pytest.mark.parametrize("n_words, short_lists", [(2, None), (5, None), (2, 3)])
def test_near_duplicates(docs, texts, n_words, short_lists, monkeypatch):
    if short_lists:  # the path of long lists
        monkeypatch.setattr(links, "GUIDES", short_lists)
    sets = {}
    for d, text, _ in texts:
        w = (text or "").encode().lower().split()
        sets[d] = {tuple(w[i:i + n_words]) for i in range(len(w) - n_words + 1)} or ({tuple(w)} if w else set())
    root = roots(sets, similar_pairs(sets))
    got = by_id(near_dedup.near_duplicates(docs, n_words=n_words))
    assert {d: (r.n_shingles, r.component_id, r.kept) for d, r in got.items()} == {d: (len(sets[d]), root[d], root[d] == d) for d in sets}
    assert sum(root[d] != d for d in sets) > 5


def test_pipeline_keeps_clean_rows_of_repeated_ids(spark):
    base = [f"w{i}" for i in range(60)]
    copy, clean = " ".join([*base[:59], "other"]), " ".join(f"c{i}" for i in range(60))
    rows = [(2, " ".join(base), "a"), (5, clean, "b"), (5, copy, "c"), (6, None, "d"), (None, " ".join(base), "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    left = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert left.columns == docs.columns and {r.source for r in left.collect()} == {"a", "b", "d", "e"}


def test_near_duplicates_of_odd_rows(odd, docs):
    rows = near_dedup.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    assert [r.kept for r in rows if r.id == 5] == [True, True]
    assert [(r.component_id, r.kept) for r in rows if r.id is None] == [(None, True)]
    assert near_dedup.near_duplicates(empty(docs)).count() == 0


# --- 2 ---------------------------------------------------------------------------
def plain_targets(sizes, weights, cap=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(cap * sizes[s] for s in full)
        share = {s: cap * sizes[s] if s in full else rest * weight[s] / sum(weight[x] for x in sizes if x not in full) for s in sizes}
        more = {s for s in sizes if s not in full and share[s] > cap * sizes[s]}
        if not more:
            return share
        full |= more


def test_mixture(docs, texts):
    sizes, by_source = {d: len(words(x)) for d, x, _ in texts}, defaultdict(int)
    source = {d: s for d, _, s in texts}
    for d, n in sizes.items():
        by_source[source[d]] += n
    want = plain_targets(by_source, (1, 2, 3))
    found = mixing.mix_sources(docs, block=8)
    got = by_id(found)
    taken = defaultdict(int)
    for d, r in got.items():
        assert (r["size"], r.source_size, r.target) == (sizes[d], by_source[source[d]], pytest.approx(want[source[d]]))
        assert r.taken == r.copies * sizes[d] and r.copies <= 3
        taken[source[d]] += r.taken
    for s, n in by_source.items():
        rate = want[s] / n if n else 0
        own = [sizes[d] for d in sizes if source[d] == s]
        assert abs(taken[s] - want[s]) <= max(own) * (rate % 1 > 0)
        assert abs(sum(got[d].copies for d in sizes if source[d] == s) - rate * len(own)) < 1 + 1e-6
    again = by_id(mixing.mix_sources(docs.repartition(7), block=8))
    assert {d: r.taken for d, r in got.items()} == {d: r.taken for d, r in again.items()}


def test_mixture_of_odd_rows(odd, docs):
    assert mixing.mix_sources(odd).count() == odd.count()
    assert mixing.mix_sources(empty(docs)).count() == 0


# --- 3 ---------------------------------------------------------------------------
PAGES = [(1, "http://a b/\n", "<p>é</p>"), (2, None, None), (3, "x", ""), (4, "https://x", "line\r\n\r\nWARC/1.1\n\nhttp://y 0 0 0 5\n"), (5, "u", "<p>é</p>"), (6, "u", "\n"),
         (7, "u", "z" * 300000 + "\r"), (None, "u", "<p>é</p>")]


def test_archives_round_trip(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("key", F.lit("clash")).repartition(3)
    got = {r.key: r for r in warc.archive_pages(pages).collect()}
    assert set(got) == {p[0] for p in PAGES}
    first = {}
    for key, _, html in sorted(PAGES, key=lambda p: (p[0] is None, p[0])):
        body = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        kind = "revisit" if body in first else "response"
        refers = first.setdefault(body, key) if kind == "revisit" else first.setdefault(body, key) and None
        r = got[key]
        assert (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) == (len(body), digest, kind, refers)


def test_archive_fields_and_failures(spark, tmp_path):
    pages = spark.createDataFrame(PAGES[:4], "page_id long, url string, html string").repartition(2)
    arc, out = str(tmp_path / "arc"), str(tmp_path / "warc")
    warc.write_arc(pages, arc)
    records = warc.read_arc(spark, arc).collect()
    assert sorted(r.key for r in records if r.kind == "response") == [1, 2, 3, 4] and any(r.kind == "warcinfo" for r in records)
    assert {r.url for r in records if r.key in (1, 2)} == {"http://a%20b/%0A", "unknown:"} and len({r.record_id for r in records}) == len(records)
    warc.convert(spark, arc, out)
    assert {(r.key, bytes(r.payload)) for r in warc.read_warc(spark, out).collect() if r.kind == "response"} == {(p[0], (p[2] or "").encode()) for p in PAGES[:4] if p[0] != 3}
    spark.createDataFrame([("http://x 0 0 text/html 3\nabc",)], "value string").write.options(lineSep="\n", **warc.GZIP).text(str(tmp_path / "bad"))
    with pytest.raises(Exception, match="version block"):
        warc.read_arc(spark, str(tmp_path / "bad")).collect()
    assert warc.archive_pages(pages.where("page_id < 0")).count() == 0


def test_old_archive_forms(spark, tmp_path):
    """Heads that end in LF alone, captures without a head, short dates."""
    captures = [("http://a/", "200101020304", b"HTTP/1.0 200 OK\nX-Record-Key: 1\n\npage one"), ("http://b/", "20010102", b"HTTP/1.0 200 OK\n\npage two"),
                ("http://c/", "20010102030405", b"<html>no head\r\n\r\nat all</html>"), ("http://d/", "20010102030405", b"HTTP/1.0 204 No Content\r\n"),
                ("http://e/", "20010102030405", b"HTTP/1.0 200 OK\r\n\r\npage one")]
    block = f"1 0 old\n{warc.ARC_FIELDS[1]}\n"
    records = [f"filedesc://old.arc 0.0.0.0 20010101000000 text/plain {len(block)}\n{block}".encode()]
    records += [f"{url} 0.0.0.0 {date} text/html {len(c)}\n".encode() + c for url, date, c in captures]
    spark.createDataFrame([(r.decode(),) for r in records], "value string").coalesce(1).write.options(lineSep="\n", **warc.GZIP).text(str(tmp_path / "arc"))
    got = {r.url: r for r in warc.read_arc(spark, str(tmp_path / "arc")).collect()}
    assert [(bytes(got[u].payload), got[u].kind, got[u].date) for u, _, _ in captures] == [
        (b"page one", "response", "2001-01-02T03:04:00Z"), (b"page two", "response", "2001-01-02T00:00:00Z"), (captures[2][2], "resource", "2001-01-02T03:04:05Z"),
        (b"", "response", "2001-01-02T03:04:05Z"), (b"page one", "response", "2001-01-02T03:04:05Z")]
    assert got["http://a/"].key == 1
    warc.convert(spark, str(tmp_path / "arc"), str(tmp_path / "warc"))
    kinds = {r.url: r.kind for r in warc.read_warc(spark, str(tmp_path / "warc")).collect()}
    assert {kinds["http://b/"], kinds["http://c/"]} == {"response", "resource"} and sorted([kinds["http://a/"], kinds["http://e/"]]) == ["response", "revisit"]
    with pytest.raises(ValueError, match="not an ARC date"):
        warc.warc_date("2001010203040")


# --- 4 ---------------------------------------------------------------------------
def plain_pooled(text, vectors):
    """Features of one text, word by word."""
    plain, shapes, kinds = [], [], np.zeros(4)
    for w in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode()):
        counts = [sum(quality.CLASS[b] == c for b in w) for c in range(4)]
        bucket = int(words_of(pa.array([w.decode()]), lower=True).hashes()[0]) >> (64 - quality.BUCKET_BITS)
        upper, lower, digit, sign = counts
        again = bool(plain) and plain[-1][0] == w.translate(bytes(quality_lower))
        shapes.append(min(upper, 2) + 3 * (lower > 0) + 6 * (digit > 0) + 12 * min(sign, 3) + 48 * min(len(w) // 4, 5) + 288 * again + (1 << quality.BUCKET_BITS))
        plain.append((w.translate(bytes(quality_lower)), bucket))
        kinds += counts
    if not plain:
        return np.zeros(2 * quality.DIMS + 9)
    means = [np.mean([vectors[b] for _, b in plain], axis=0), np.mean([vectors[s] for s in shapes], axis=0)]
    n, letters = len(plain), kinds.sum()
    return np.concatenate([*means, [np.linalg.norm(means[0]), np.linalg.norm(means[1]), np.log1p(n), len({b for _, b in plain}) / n, letters / n / 8], kinds / letters])


quality_lower = [b + 32 if 65 <= b <= 90 else b for b in range(256)]


def test_quality_scores_equal_a_plain_version(spark, texts):
    docs = spark.createDataFrame([(d, t) for d, t, _ in texts], "doc_id long, text string")
    labels = spark.createDataFrame([(d, d % 2) for d, _, _ in texts], "doc_id long, quality int")
    net = quality.fit(docs, labels)
    got = by_id(quality.score(docs, net))
    for d, text, _ in texts[::7] + texts[-10:]:
        if text and len(text) > 50000:
            continue
        x = np.clip((plain_pooled(text, net.vectors) - net.mean) / net.scale, -8, 8)
        a, b, c, e = net.layers
        z = (np.tanh(x @ a + b) @ c + e)[0] / net.temperature
        assert got[d].score == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-3)


def test_quality_bound_counts_texts(spark, monkeypatch):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(400)] + [(i, f"other {i}") for i in range(2, 30)], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 30)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "train", lambda x, y, vectors: seen.append(len(y)))
    quality.fit(docs, labels, most_rows=10)
    quality.fit(docs, labels)
    assert seen == [10, 29]


def test_quality(spark):
    draw = random.Random(4)
    rows, labels = [], []
    for i in range(400):
        good = draw.random() < 0.6
        text = sentence(draw, draw.randrange(20, 80))
        rows.append((i, text if good else draw.choice([text.upper().replace(" ", "!! "), " ".join(w + "###" for w in text.split()), f"w{i} " * 40]), "kept"))
        labels.append((i, int(good), 0))
    docs = spark.createDataFrame([*rows, (1000, None, "x"), (1001, "", "x"), (1001, "", "x"), (None, "a", "x"), (1002, "long " * 50000, "x")], "doc_id long, text string, score string")
    marks = spark.createDataFrame([*labels, (None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    net = quality.fit(docs, marks.where(~quality.held_out("doc_id")))
    found = quality.score(docs, net).collect()
    got = {r.id: r.score for r in found}
    assert len(found) == docs.count() and all(0 <= r.score <= 1 for r in found) and got[1000] == got[1001]
    held = [(i, y) for i, y, _ in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(held) > 60 and np.mean([(got[i] >= 0.7) == y for i, y in held]) > 0.95
    assert np.mean([-math.log(max(got[i] if y else 1 - got[i], 1e-9)) for i, y in held]) < 0.2
    again = quality.score(docs.repartition(5), quality.fit(docs.repartition(5), marks.where(~quality.held_out("doc_id")))).collect()
    assert {r.id: pytest.approx(r.score, abs=1e-3) for r in again} == got
    assert quality.keep(docs, net).columns == docs.columns
    assert quality.score(docs, quality.fit(docs, marks.limit(0))).first().score == 0.5
    assert quality.score(docs.limit(0), net).count() == 0


# --- 5 ---------------------------------------------------------------------------
@pytest.mark.parametrize("short_lists", [None, 3])
def test_line_duplicates(docs, texts, short_lists, monkeypatch):
    if short_lists:
        monkeypatch.setattr(links, "GUIDES", short_lists)
    draw = random.Random(8)
    base = sentence(draw, 40)
    more = [(500 + i, f"  \n{base[:i % 5]}{base}{i}\nown {sentence(draw, 9)}\nx\n", "s") for i in range(20)]
    rows = [*texts, *more]
    spark = docs.sparkSession
    lines = [(d, i, x) for d, text, _ in sorted(rows) for i, x in enumerate((text or "").split("\n")) if x.strip(" \t\n\x0b\x0c\r")]
    sets = {x: {x[k:k + 9] for k in range(max(1, len(x) - 8))} for _, _, x in lines}
    root = roots(sets, similar_pairs(sets))
    first, kept = set(), {}
    for d, i, x in lines:
        kept[d, i] = root[x] not in first
        first.add(root[x])
    frame = spark.createDataFrame(rows, "doc_id long, text string, line_no string").repartition(3)
    found = line_dedup.line_duplicates(frame)
    assert {(r.id, r.line_no): r.kept for r in found.collect()} == kept
    assert sum(not x for x in kept.values()) > 20
    texts_left = by_id(line_dedup.remove_lines(frame, found))
    for d, text, _ in rows:
        left = [x for i, x in enumerate((text or "").split("\n")) if kept.get((d, i), True)]
        assert texts_left[d].text == "\n".join(left)


def test_line_dedup_query_returns_every_document(spark, tmp_path):
    line = "the same long line of text in two documents"
    rows = [(1, f"{line}\nown words of the first"), (2, f"\n{line}\n{line}\nquite other words here\n"), (3, None), (4, ""), (5, " \n\t"), (6, line)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: tuple(r)[1:] for r in line_dedup.op5_line_dedup(spark, str(tmp_path)).collect()}

    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    assert got == {1: (2, 0, [], digest(rows[0][1])), 2: (5, 2, [1, 2], digest("\nquite other words here\n")), 3: (1, 0, [], digest("")), 4: (1, 0, [], digest("")),
                   5: (2, 0, [], digest(" \n\t")), 6: (1, 1, [0], digest(""))}


def test_short_lines_are_matched_exactly(spark):
    """Pairs at the threshold whose signatures say little: 4 of 5 and 8 of 10 shingles, and lines of one shingle many times over."""
    draw, rows = random.Random(11), []
    for i in range(400):
        text = "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(18))
        n = draw.choice([12, 16])
        rows += [(2 * i, text[:n]), (2 * i + 1, text[:n + 1] if n == 12 else text[:n + 2])]
    rows += [(2000, "=" * 20), (2001, "=" * 700), (2002, "ab" * 9), (2003, "ab" * 300)]
    found = line_dedup.line_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.id: r.kept for r in found.collect()} == {i: i % 2 == 0 for i, _ in rows}


def test_line_signatures_of_long_lines(spark):
    """Pairs at 4 of 5 shingles share a band about as often as independent values would."""
    draw, lines = random.Random(12), []
    for i in range(1500):
        text = "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(108))
        lines += [(2 * i, text[:88]), (2 * i + 1, text[:108])]  # 80 of 100
    nodes = spark.createDataFrame(lines, "node long, line string").withColumn("n", F.char_length("line") - 8)
    sigs = {r.node: r.sig for r in line_dedup.signatures(nodes).collect()}
    bands = range(line_dedup.BANDS)
    missed = sum(not any(sigs[2 * i][3 * b:3 * b + 3] == sigs[2 * i + 1][3 * b:3 * b + 3] for b in bands) for i in range(1500))
    assert missed / 1500 <= 0.01


def test_no_lines(docs):
    assert line_dedup.line_duplicates(empty(docs)).count() == 0


# --- 6 ---------------------------------------------------------------------------
def plain_model(train):
    def tokens(x):
        return [*(x or "").encode().lower().split(), None]

    single, pairs = Counter(), Counter()
    for x in train:
        w = tokens(x)
        single.update(w)
        pairs.update(zip([0, *w], w))
    total, kinds, context = Counter(), Counter(), defaultdict(lambda: [0, 0, 0])
    for (u, w), c in pairs.items():
        total[u] += c
        kinds[w] += 1
        context[u][min(c, 3) - 1] += 1

    def discounts(counts):
        return (0, *language_model.discounts(*[sum(c == k for c in counts.values()) for k in (1, 2, 3, 4)]))

    d2, d1 = discounts(pairs), discounts(kinds)
    left = sum(d1[min(c, 3)] for c in kinds.values()) / len(pairs) if pairs else 1

    def probability(u, w):
        low = (max(kinds[w] - d1[min(kinds[w], 3)], 0) / len(pairs) if pairs else 0) + left / (len(single) + 1)
        if not total[u]:
            return low
        return (max(pairs[u, w] - d2[min(pairs[u, w], 3)], 0) + sum(d * n for d, n in zip(d2[1:], context[u])) * low) / total[u]

    return single, tokens, probability


def test_language_model(docs, odd, texts):
    train = [x for d, x, _ in texts if zlib.crc32(str(d).encode()) % 7 != 2]
    single, tokens, probability = plain_model(train)
    model = language_model.fit(docs.where(~language_model.held_out("doc_id")))
    got = by_id(language_model.score(docs, model))
    n, v = sum(single.values()), len(single)
    for d, x, _ in texts:
        w, r = tokens(x), got[d]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(single[t] > 0 for t in w), n)
        assert r.base_score == pytest.approx(sum(math.log10((single[t] + 1) / (n + v + 1)) for t in w))
        assert r.score == pytest.approx(sum(math.log10(probability(a, b)) for a, b in zip([0, *w], w)))
    some = list(single)
    for u in (0, some[0], some[-1], b"never seen"):
        assert sum(probability(u, w) for w in some) + probability(u, b"?") == pytest.approx(1)
    assert language_model.score(odd, model).count() == odd.count()
    nothing = language_model.fit(empty(docs))
    assert language_model.score(docs.where("doc_id = 103"), nothing).first().score == pytest.approx(0)


# --- 7 ---------------------------------------------------------------------------
def plain_repeats(rows, width):
    first, out = {}, {}
    rows = sorted(rows)
    for d, x in rows:
        w = words(x)
        for i in range(len(w) - width + 1):
            first.setdefault(tuple(w[i:i + width]), (d, i))
    for d, x in rows:
        w = words(x)
        gone = set()
        for i in range(len(w) - width + 1):
            if first[tuple(w[i:i + width])] != (d, i):
                gone |= set(range(i, i + width))
        out[d] = (len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone))
    return out


@pytest.mark.parametrize("width", [20, 3])
def test_repeated_windows(docs, texts, width):
    want = plain_repeats([(d, x) for d, x, _ in texts], width)
    got = by_id(substring_dedup.remove_repeats(docs, width=width))
    for d, (n, gone, kept) in want.items():
        assert (got[d].n_words, got[d].n_removed, got[d].text, got[d].kept_sha256) == (n, gone, kept.decode(), hashlib.sha256(kept).hexdigest())
    assert sum(g for _, g, _ in want.values()) > 500


def test_repeated_windows_of_odd_rows(odd, docs):
    found = substring_dedup.remove_repeats(odd).collect()
    assert len(found) == odd.count()
    assert [r.n_removed == r.n_words for r in found if r.id is None] == [len(words(odd.where("doc_id = 6").first().text)) >= 20 or False]
    assert substring_dedup.remove_repeats(empty(docs)).count() == 0


# --- 8 ---------------------------------------------------------------------------
def test_byte_pairs(spark, docs, odd, texts):
    import public_tokenizers
    import tiktoken

    ranks = bpe.read_file(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(ranks), special_tokens={})
    got = by_id(bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks))
    for d, x, _ in texts:
        assert list(got[d].ids) == plain.encode_ordinary(x or "") and bytes(got[d].decoded) == (x or "").encode()
    marks = by_id(bpe.encode_and_decode(spark, docs), "doc_id")
    assert marks[109].ids_sha256 == hashlib.sha256(",".join(map(str, plain.encode_ordinary(texts[109][1]))).encode()).hexdigest()
    assert bpe.encode(odd, ranks, public_tokenizers.PATTERN).count() == odd.count()
    assert bpe.encode_and_decode(spark, empty(docs)).count() == 0


def test_long_texts_are_cut_at_safe_places(monkeypatch):
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(f.read()), special_tokens={})
    monkeypatch.setattr(bpe, "PIECE_CHARS", 7)
    draw = random.Random(1)
    for _ in range(300):
        text = "".join(draw.choice(["a", "Bc", "'s", "12", " ", "  ", "\n", "\t", " ", "é", "!", "…", "日", "\x1c", "don't "]) for _ in range(60))
        assert list("".join(bpe.pieces(text, 7))) == list(text)
        assert [i for part in bpe.pieces(text, 7) for i in plain.encode_ordinary(part)] == plain.encode_ordinary(text)


# --- 9 ---------------------------------------------------------------------------
@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact_duplicates(spark, docs, odd, texts, keep):
    copies = spark.createDataFrame([(1000 + i, "same " * 9) for i in range(300)], "doc_id long, text string")  # one hot text
    frame = docs.select("*").unionByName(copies, allowMissingColumns=True)
    groups = defaultdict(list)
    for d, x in [(d, x or "") for d, x, _ in texts] + [(1000 + i, "same " * 9) for i in range(300)]:
        groups[x].append(d)
    found = exact_dedup.exact_dedup(frame, keep=keep)
    assert sorted(found.columns) == sorted([*[c for c in docs.columns if c != "kept"], "keep_id", "group_size", "kept", "text_sha256"])
    got = by_id(found, "doc_id")
    for x, ids in groups.items():
        best = max(ids) if keep == "largest" else min(ids)
        for d in ids:
            assert (got[d].keep_id, got[d].group_size, got[d].kept, got[d].text_sha256) == (best, len(ids), d == best, hashlib.sha256(x.encode()).hexdigest())
    rows = exact_dedup.exact_dedup(odd, keep=keep).collect()
    assert len(rows) == odd.count() and sum(r.kept for r in rows if r.doc_id == 5) == 1 and not any(r.kept for r in rows if r.doc_id is None)
    assert exact_dedup.exact_dedup(empty(docs)).count() == 0


def test_equal_after_normalising(spark):
    rows = spark.createDataFrame([(1, "A b"), (2, "a B "), (3, "ab")], "doc_id long, text string")
    got = by_id(exact_dedup.exact_dedup(rows, normalise=lambda c: F.lower(F.trim(c))), "doc_id")
    assert (got[2].keep_id, got[3].keep_id) == (1, 3)


def test_one_exchange_and_one_sort_of_the_texts(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    plan = exact_dedup.exact_dedup(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort ") == 1 and "Python" not in plan and "Arrow" not in plan


# --- 10 --------------------------------------------------------------------------
def test_nearest(spark):
    draw = np.random.default_rng(2)
    vectors = draw.standard_normal((3000, 24)) * draw.uniform(0.2, 3, (3000, 1))
    vectors[1000:1200] = vectors[20]  # ties
    rows = [(i, [float(x) for x in np.float32(v)], 1) for i, v in enumerate(vectors)]
    bad = [(5000, None, 1), (5020, [0.0] * 24, 1), (5040, [float("nan")] * 24, 1), (5060, [1.0] * 23 + [None], 1), (5080, [float("inf")] + [1.0] * 23, 1), (5100, [], 1), (5120, [1.0], 1), (None, [1.0] * 24, 1)]
    frame = spark.createDataFrame([*rows, *bad], "vec_id long, embedding array<float>, rank int")
    got = defaultdict(list)
    for r in nearest.nearest(frame, block=1000, queries_per_task=70).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    exact = np.array([r[1] for r in rows])
    hits = 0
    for q in range(0, 3000, 20):
        found = sorted(got.pop(q))
        assert [f[0] for f in found] == list(range(1, 21)) and q not in [f[1] for f in found]
        assert all(s == pytest.approx(float(exact[q] @ exact[v]), abs=1e-12) for _, v, s in found)
        assert [(-s, v) for _, v, s in found] == sorted((-s, v) for _, v, s in found)
        scores = exact @ exact[q]
        best = [i for i in np.lexsort((np.arange(3000), -np.round(scores, 12))) if i != q][:20]
        hits += len(set(best) & {v for _, v, _ in found})
    assert not got and hits / (150 * 20) >= 0.9
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.0]), (2, [0.5, 0.0])], "vec_id long, embedding array<double>")
    assert [(r.rank, r.vec_id) for r in nearest.nearest(few).orderBy("rank").collect()] == [(1, 1), (2, 2)]
    assert nearest.nearest(few.limit(0)).count() == 0


@pytest.mark.parametrize("table", ["sf0.001", "sf0.01", "sf0.1"])
def test_nearest_recall_on_given_tables(spark, table):
    given = spark.read.parquet(f"/root/testdata/{table}/embeddings.parquet").orderBy("vec_id").collect()
    vectors = np.array([r.embedding for r in given], dtype=float)
    for order in range(4):  # as given, and under reshuffled ids
        ids = np.array([r.vec_id for r in given])
        if order:
            ids = np.random.default_rng(order).permutation(ids)
        frame = spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(ids, vectors)], "vec_id long, embedding array<double>")
        got = defaultdict(set)
        for r in nearest.nearest(frame).collect():
            got[r.query_id].add(r.vec_id)
        hits, queries = 0, np.flatnonzero(ids % 20 == 0)
        for q in queries:
            best = [i for i in np.lexsort((ids, -np.round(vectors @ vectors[q], 12))) if i != q][:20]
            hits += len({int(ids[i]) for i in best} & got[ids[q]])
        assert hits / (20 * len(queries)) >= 0.9


def test_nearest_does_not_depend_on_other_queries():
    draw = np.random.default_rng(4)
    vectors = draw.standard_normal((400, 16))
    block = nearest.Block(vectors, np.arange(400), float(np.linalg.norm(vectors, axis=1).max()), 64, 10)
    width = block.norm
    together = block.search(vectors[:30], np.arange(30), 20, 0.8, 0.02, width)
    for q in range(30):
        alone = block.search(vectors[q:q + 1], np.arange(q, q + 1), 20, 0.8, 0.02, width)[0]
        assert together[q].vec_id.tolist() == alone.vec_id.tolist()
