"""Operator 8: byte-level BPE with the tiktoken library and a local rank file."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from menumix.llm.frames import small_batches, trimmed

PIECE_CHARS = 20_000
BATCH_BYTES = 4 << 20
# A match never runs on over this place: white space after something else
# starts a match, and no look-ahead of the pattern sees past white space from before it.
SAFE = regex.compile(r"(?<=\S)(?=\s)")


def load_ranks(content: bytes) -> dict[bytes, int]:
    """Ranks of a rank file: lines of base64 token and rank."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines()) if token}


def read_file(spark: SparkSession, path: str) -> bytes:
    """Content of a rank file (about a megabyte) that the driver can open."""
    with open(path, "rb") as f:
        return f.read()


def pieces(text: str, limit: int = PIECE_CHARS) -> Iterator[str]:
    """Parts of a long text, cut at the first safe place from ``limit`` characters on."""
    begin = 0
    while len(text) - begin > limit:
        cut = SAFE.search(text, begin + limit)
        if cut is None:
            break
        yield text[begin:cut.start()]
        begin = cut.start()
    yield text[begin:]


def encode_text(encoding: tiktoken.Encoding, text: str) -> list[int]:
    if len(text) <= PIECE_CHARS:
        return encoding.encode_ordinary(text)
    return [i for part in pieces(text) for i in encoding.encode_ordinary(part)]


def _encoding(ranks: dict[bytes, int], pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _groups(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges whose sizes add up to about ``limit``."""
    ends, begin = np.cumsum(sizes), 0
    while begin < len(sizes):
        end = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + limit, side="right")))
        yield begin, end
        begin = end


def _encoder(ranks: Broadcast, pattern: str):
    """(id, text) batches to (id, ids)."""
    def run(batches):
        encoding = _encoding(load_ranks(ranks.value), pattern)
        for batch in batches:
            texts = batch.column(1).fill_null("")
            for a, b in _groups(pa.compute.binary_length(texts).to_numpy(zero_copy_only=False), BATCH_BYTES):
                found = [np.array(encode_text(encoding, t), dtype=np.int32) for t in texts.slice(a, b - a).to_pylist()]
                offsets = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found) if found else [], pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), ids], names=["id", "ids"])

    return run


def _decoder(ranks: Broadcast):
    """(id, ids) batches to (id, ids, decoded)."""
    def run(batches):
        by_id = {i: token for token, i in load_ranks(ranks.value).items()}
        tokens = [by_id.get(i) for i in range(max(by_id) + 1)]
        for batch in batches:
            lists = batch.column(1).fill_null(pa.scalar([], batch.column(1).type)) if batch.column(1).null_count else batch.column(1)
            offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            for a, b in _groups(np.diff(offsets), BATCH_BYTES):
                raw = [b"".join([tokens[i] for i in flat[offsets[k]:offsets[k + 1]].tolist()]) for k in range(a, b)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists.slice(a, b - a), pa.array(raw, pa.binary())], names=["id", "ids", "decoded"])

    return run


def _digester(with_ids: bool):
    """(id, ids, decoded) batches to (id, n_tokens, ids_sha256, decoded_sha256), and the ids if wanted."""
    def run(batches):
        for batch in batches:
            lists, decoded = batch.column(1), batch.column(2)
            offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            ids = [hashlib.sha256(",".join(map(str, flat[offsets[k]:offsets[k + 1]].tolist())).encode()).hexdigest() for k in range(len(lists))]
            columns = {"id": batch.column(0), "n_tokens": pa.array(np.diff(offsets).astype(np.int64)), "ids_sha256": pa.array(ids, pa.string()),
                       "decoded_sha256": pa.array([hashlib.sha256(d.as_buffer()).hexdigest() for d in decoded], pa.string())}
            yield pa.RecordBatch.from_pydict(columns | ({"ids": lists} if with_ids else {}))

    return run


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))


def encode(df: DataFrame, ranks: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): the token ids of every text, each pattern match merged by itself.

    Null text counts as empty and has no ids. Rows are taken one by one, so
    repeated rows and ids stay; other columns are left out. No shuffle.
    """
    sent = df.sparkSession.sparkContext.broadcast(ranks)  # a rank file: about 1 MB, whatever the input
    return _texts(df, id_col, text_col).mapInArrow(_encoder(sent, pattern), "id long, ids array<int>")


def decode(df: DataFrame, ranks: bytes, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """(id, ids, decoded): the raw bytes of the ids, joined without any repair
    of partial characters. Null ids decode to no bytes; an id without rank fails."""
    sent = df.sparkSession.sparkContext.broadcast(ranks)
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).alias("ids")).mapInArrow(_decoder(sent), "id long, ids array<int>, decoded binary")


def encode_and_decode(spark: SparkSession, docs: DataFrame, path: str | None = None, pattern: str | None = None, with_ids: bool = False) -> DataFrame:
    """Digest rows of every document, by the multilingual rank file unless ``path`` names another.

    Encoding, decoding and digests run in one worker, one after the other on each batch: a task needs one process and no
    list of ids crosses to the JVM and back."""
    import public_tokenizers

    sent = spark.sparkContext.broadcast(read_file(spark, path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))
    encoder, decoder, digester = _encoder(sent, pattern or public_tokenizers.PATTERN), _decoder(sent), _digester(with_ids)
    small_batches(spark)
    schema = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return _texts(docs, "doc_id", "text").mapInArrow(trimmed(lambda batches: digester(decoder(encoder(batches)))), schema).withColumnRenamed("id", "doc_id")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_and_decode(spark, spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
