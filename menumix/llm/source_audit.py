"""Operator 11: how far the sources of a language are from each other, over a vocabulary kept as minimal acyclic transducers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from menumix.llm.arrays import shared_dir
from menumix.llm.transducer import Shard, Vocabulary, store
from menumix.llm.words import Words, slices, words_of
from menumix.session import materialise

LEAST_DOCS = 30
ADDED = 5
SCALE = 1_000_000_000
MOST_TERMS = 50
SHARD_TERMS = 1 << 16
BLOCK = 512  # terms that are compared across the sources at once
NO_TERM = np.zeros(256, dtype=bool)
NO_TERM[:0x41] = NO_TERM[0x5B:0x61] = NO_TERM[0x7B:0x80] = True


def _distinct(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(a position of each different word, number of each word's kind); kinds go by 64-bit hashes within one slice."""
    _, first, kind = np.unique(w.hashes(seed=11), return_index=True, return_inverse=True)
    return first, kind


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    sizes = ends - starts
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    at = np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(data[at].tobytes()))


def _codes(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    coded = column.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Words, np.ndarray]]:
    """(rows, words, row of each word) of slices of bounded size."""
    for batch in batches:
        texts = batch.column(batch.num_columns - 1)
        for a, b in slices(texts):
            w = words_of(texts.slice(a, b - a), lower=True, stops=NO_TERM)
            yield batch.slice(a, b - a), w, np.repeat(np.arange(b - a), np.diff(w.bounds))


def kept_terms(docs: DataFrame, least_docs: int) -> DataFrame:
    """(lang, term) of the terms in at least ``least_docs`` documents of a language; tasks send document counts, no words."""
    def run(batches):
        for rows, w, row in _texts(batches):
            langs, names = _codes(rows.column(0))
            first, kind = _distinct(w)
            pairs = np.unique(row * max(len(first), 1) + kind)
            keys, df = np.unique(langs[pairs // max(len(first), 1)] * max(len(first), 1) + pairs % max(len(first), 1), return_counts=True)
            lang, kind = keys // max(len(first), 1), first[keys % max(len(first), 1)]
            yield pa.RecordBatch.from_arrays([names.take(pa.array(lang)), _strings(w.data, w.starts[kind], w.ends[kind]), pa.array(df)], names=["lang", "term", "df"])

    found = docs.select("lang", "text").mapInArrow(run, "lang string, term string, df long")
    return found.groupBy("lang", "term").agg(F.sum("df").alias("df")).where(F.col("df") >= least_docs).select("lang", "term")


def vocabulary(terms: DataFrame, folder: str) -> dict[str, list[Shard]]:
    """Write the transducers of (lang, term) rows, one for at most 2^16 terms in order, and return their places: what
    the driver holds is one entry for so many terms (and one a range and language)."""
    def run(batches):
        part, made, held, lang = TaskContext.get().partitionId(), 0, [], None

        def flush():
            name = part * 1_000_000 + made
            return pa.RecordBatch.from_pylist([{"lang": lang, "name": name, "first": held[0], "n": len(held), "longest": store(folder, name, held)}],
                                              schema=pa.schema([("lang", pa.string()), ("name", pa.int64()), ("first", pa.binary()), ("n", pa.int64()), ("longest", pa.int64())]))

        for batch in batches:
            for here, term in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                if held and (here != lang or len(held) >= SHARD_TERMS):
                    yield flush()
                    made, held = made + 1, []
                lang = here
                held.append(term)
        if held:
            yield flush()

    parts = max(1, -(-terms.count() // SHARD_TERMS))
    ranged = terms.repartitionByRange(parts, "lang", "term").sortWithinPartitions("lang", "term")
    shards: dict[str, list[Shard]] = {}
    base = 0
    for r in sorted(ranged.mapInArrow(run, "lang string, name long, first binary, n long, longest long").collect(), key=lambda r: (r.lang.encode(), bytes(r.first))):
        base = base if r.lang in shards else 0
        shards.setdefault(r.lang, []).append(Shard(r.name, bytes(r.first), base, r.longest))
        base += r.n
    return shards


def recount(docs: DataFrame, folder: str, shards: dict[str, list[Shard]]) -> DataFrame:
    """(lang, source, ord, n): occurrences of the kept terms, each slice's different words walking through the transducers of its languages."""
    def run(batches):
        held = Vocabulary(folder, shards)
        for rows, w, row in _texts(batches):
            langs, lang_names = _codes(rows.column(0))
            sources, source_names = _codes(rows.column(1))
            first, kind = _distinct(w)
            size = max(len(first), 1)
            group = langs * len(source_names) + sources
            keys, n = np.unique(group[row] * size + kind, return_counts=True)
            lang, kind = keys // size // len(source_names), keys % size
            ordinal = np.full(len(keys), -1, np.int64)
            for code, name in enumerate(lang_names.to_pylist()):
                mine = np.flatnonzero(lang == code)
                asked, back = np.unique(kind[mine], return_inverse=True)
                words = first[asked]
                ordinal[mine] = held.ordinals(name, w.data, w.starts[words], w.ends[words])[back]
            some = np.flatnonzero(ordinal >= 0)
            yield pa.RecordBatch.from_arrays(
                [lang_names.take(pa.array(lang[some])), source_names.take(pa.array(keys[some] // size % len(source_names))), pa.array(ordinal[some]), pa.array(n[some])],
                names=["lang", "source", "ord", "n"])

    found = docs.select("lang", "source", "text").mapInArrow(run, "lang string, source string, ord long, n long")
    return found.groupBy("lang", "source", "ord").agg(F.sum("n").alias("n"))


def weight(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + ADDED) / (total + ADDED * terms)) in whole decimals, which hold counts beyond 64 bits times SCALE; 0 without terms."""
    wide = "decimal(28,0)"
    above = ((n + ADDED).cast(wide) * F.lit(SCALE).cast("decimal(10,0)"))
    below = F.when(terms > 0, (total + ADDED * terms)).cast(wide)
    return F.coalesce(F.call_function("div", above, below) + 1, F.lit(0).cast("long"))


def _compare(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """Sums of differences between all sources over one block of terms, and the block's terms that stand out most in each source.

    ``rows`` hold for every group its weight of absent terms (ord null) and those of present ones; the language's own have a null source."""
    lang, block = key[0].as_py(), key[1].as_py()
    source, order, p, width = (rows.column(c) for c in ("source", "ord", "p", "width"))
    absent = order.is_null().to_numpy() & source.is_valid().to_numpy()
    names = source.filter(pa.array(absent)).combine_chunks()
    base = p.to_numpy()[absent]
    place = pa.compute.index_in(source, value_set=names).fill_null(-1).to_numpy()
    at = order.fill_null(0).to_numpy() - block * BLOCK
    present = order.is_valid().to_numpy()
    width = int(width.to_numpy()[0])
    table = np.repeat(base[:, None], width, axis=1)
    mine = present & (place >= 0)
    table[place[mine], at[mine]] = p.to_numpy()[mine]
    whole = np.zeros(width, np.int64)
    whole[at[present & (place < 0)]] = p.to_numpy()[present & (place < 0)]
    left, right, sums = [], [], []
    for i in range(len(names)):
        others = np.flatnonzero(np.arange(len(names)) != i)
        left.append(np.full(len(others), i))
        right.append(others)
        sums.append(np.abs(table - table[i]).sum(axis=1)[others])
    who, where = place[mine], at[mine]
    over = table[who, where] - whole[where]
    rank = np.lexsort((where, -over, who))
    rank = rank[over[rank] > 0]
    nth = np.arange(len(rank)) - np.searchsorted(who[rank], who[rank])
    rank = rank[nth < MOST_TERMS]
    groups = np.concatenate([*left, who[rank]]).astype(np.int64) if len(names) else np.zeros(0, np.int64)
    n_pairs = sum(map(len, right))
    items = np.concatenate([*right, np.zeros(0, np.int64)]).astype(np.int64)
    return pa.table({
        "lang": pa.array([lang] * len(groups), pa.string()), "source": names.take(pa.array(groups)),
        "other": pa.concat_arrays([names.take(pa.array(items)).cast(pa.string()), pa.nulls(len(rank), pa.string())]),
        "ord": pa.concat_arrays([pa.nulls(n_pairs, pa.int64()), pa.array(where[rank] + block * BLOCK, pa.int64())]),
        "value": pa.array(np.concatenate([*sums, over[rank]]).astype(np.int64))})


def audit(df: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, source, part, item, value, rank) of every group of language and source.

    Part ``pair``: the distance to each other source of the language over all kept terms, all ranks.
    Part ``term``: the terms that a source uses more than its language, the first 50. Kept terms are those in at least ``least_docs`` documents
    (rows) of the language. A language is compared in blocks of 512 terms, each a task's group of at most 512 rows a source;
    ordinals stand for terms until the end and settle ties, for they follow the UTF-8 order.

    Null text, language and source count as empty. A language without kept terms gives pairs of value 0
    and no terms, one with a single source no pairs. Rows that repeat count each. An empty table gives an empty result.
    The transducers lie below spark.checkpoint.dir, which all executors must mount.
    """
    spark = df.sparkSession
    docs = df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    terms = materialise(kept_terms(docs, least_docs), "audit_terms")
    folder = shared_dir(spark, "audit_vocabulary")
    shards = vocabulary(terms, folder)
    counts = materialise(recount(docs, folder, shards), "audit_counts")
    sizes = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    by_source = docs.select("lang", "source").distinct().join(counts.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
    by_lang = counts.groupBy("lang").agg(F.sum("n").alias("total")).select("lang", F.lit(None).cast("string").alias("source"), "total")
    groups = by_source.unionByName(by_lang).join(sizes, "lang", "left").na.fill(0, ["total", "v"])
    groups = materialise(groups, "audit_groups")
    v, total = F.col("v"), F.col("total")
    width = F.greatest(F.least(F.lit(BLOCK), v - F.col("block") * BLOCK), F.lit(0))
    blocks = groups.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"greatest(v - 1, 0) div {BLOCK}"))).alias("block"))
    absent = blocks.select("lang", "block", "source", F.lit(None).cast("long").alias("ord"), weight(F.lit(0), total, v).alias("p"), width.alias("width"))
    every = counts.select("lang", "source", "ord", "n").unionByName(counts.groupBy("lang", "ord").agg(F.sum("n").alias("n")).withColumn("source", F.lit(None).cast("string")))
    here = groups.select(F.col("lang").alias("l"), F.col("source").alias("s"), "total", "v")
    present = every.join(here, (F.col("lang") == F.col("l")) & F.col("source").eqNullSafe(F.col("s"))).withColumn("block", F.expr(f"ord div {BLOCK}"))
    present = present.select("lang", "block", "source", "ord", weight(F.col("n"), total, v).alias("p"), width.alias("width"))
    found = absent.unionByName(present).groupBy("lang", "block").applyInArrow(_compare, "lang string, source string, other string, ord long, value long")
    found = materialise(found, "audit_blocks")
    pairs = found.where("other is not null").groupBy("lang", "source", "other").agg(F.sum("value").alias("value"))
    by_group = Window.partitionBy("lang", "source")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value", F.row_number().over(by_group.orderBy(F.desc("value"), "other")).alias("rank"))
    best = found.where("ord is not null").withColumn("rank", F.row_number().over(by_group.orderBy(F.desc("value"), "ord"))).where(F.col("rank") <= MOST_TERMS)

    def spell(batches):
        held = Vocabulary(folder, shards)
        for batch in batches:
            named = [held.term(lang, o) for lang, o in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(["term"] * batch.num_rows, pa.string()), pa.array(named, pa.string()), batch.column(3), batch.column(4)],
                                             names=["lang", "source", "part", "item", "value", "rank"])

    spelt = best.select("lang", "source", "ord", "value", "rank").mapInArrow(spell, "lang string, source string, part string, item string, value long, rank int")
    return pairs.unionByName(spelt)


def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "source", "text"))


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents),
w AS (SELECT id, lang, source, unnest(words) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
full_counts AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM g JOIN kept k USING (lang) LEFT JOIN c USING (lang, source, term)),
p AS (SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang, source) + 5 * v)::HUGEINT AS p FROM full_counts JOIN v USING (lang)),
lang_counts AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL),
q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 5)::HUGEINT) // (sum(n) OVER (PARTITION BY lang) + 5 * v)::HUGEINT AS q FROM lang_counts JOIN v USING (lang)),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT p.lang, p.source, o.source AS other, sum(abs(p.p - o.p)) AS value FROM p JOIN p o ON p.lang = o.lang AND p.term = o.term GROUP BY ALL) x
    ON x.lang = a.lang AND x.source = a.source AND x.other = b.source),
terms AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, (p.p - q.q)::BIGINT AS value FROM p JOIN q USING (lang, term) WHERE p.n > 0 AND p.p > q.q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank::INT AS rank FROM ranked WHERE part = 'pair' OR rank <= 50"""
