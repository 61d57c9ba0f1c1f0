"""Encoding of a whole corpus with a public tokenizer (problem 7).

tiktoken does the merges, from a local rank file. Long texts are cut at safe
boundaries first, so that no call sees a whole book.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.session import table, tokenizer_dir

# Fixed value: how the public byte-level vocabularies split text into pieces.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts of more characters are cut before they are encoded.
PIECE_CHARS = 16_384
# A piece never goes on from visible text into white space.
_SAFE = re.compile(r"(?<=\S)(?=\s)")


@lru_cache(maxsize=4)
def encoding(path: str):
    """The tokenizer of a rank file; built once in each Python worker."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding("local", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, limit: int = PIECE_CHARS) -> Iterator[str]:
    """Cuts of a text whose token ids, one after another, are those of the text.

    A cut is made at the first safe boundary behind the limit; where white space
    never follows visible text, the text stays whole.
    """
    start = 0
    while len(text) - start > limit:
        cut = _SAFE.search(text, start + limit)
        if not cut:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encode(text: str | None, path: str) -> list[int]:
    """Ids without special tokens; their strings are ordinary text. Null and empty text have none."""
    if not text:
        return []
    ordinary = encoding(path).encode_ordinary
    if len(text) <= PIECE_CHARS:
        return ordinary(text)
    return [i for piece in pieces(text) for i in ordinary(piece)]


def decode(ids, path: str) -> str:
    """The text of ids, joined as raw bytes before they are read as UTF-8."""
    return encoding(path).decode_bytes(list(ids)).decode("utf-8", errors="replace")


def rank_file(name: str = "byte_bpe_50k", folder: str | None = None) -> str:
    return f"{folder or tokenizer_dir()}/{name}.tiktoken"


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids): one row for each row of docs (doc_id, text)."""
    path = path or rank_file()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [encode(text, path) for text in batch.column(1).to_pylist()]
            offsets = np.zeros(len(lists) + 1, dtype=np.int32)
            np.cumsum([len(x) for x in lists], out=offsets[1:])
            flat = np.fromiter((i for x in lists for i in x), dtype=np.int32, count=int(offsets[-1]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, ids array<int>")


def decoded(tokens: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids); null ids give null."""
    path = path or rank_file()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if ids is None else decode(ids, path) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")


def counted(docs: DataFrame, keep: list[str], path: str | None = None) -> DataFrame:
    """The columns of keep and n_tokens for each row; ids are counted, not kept."""
    path = path or rank_file()
    schema = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pa.array([len(encode(text, path)) for text in batch.column("text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], sizes], names=[*keep, "n_tokens"])

    return docs.select(*keep, "text").mapInArrow(run, f"{schema}, n_tokens bigint")


def corpus_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents"))


def round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, same): whether the decoded ids are the text; null text counts as empty."""
    path = rank_file()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            lists = [encode(text, path) for text in texts]
            same = [decode(ids, path) == (text or "") for ids, text in zip(lists, texts, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in lists], pa.int64()), pa.array(same)], names=["doc_id", "n_tokens", "same"])

    return docs.mapInArrow(run, "doc_id bigint, n_tokens bigint, same boolean")


def decoded_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text): every text encoded and decoded again; null and empty text come back empty."""
    return decoded(encoded(table(spark, sf_dir, "documents")))


def tokens_by_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = counted(table(spark, sf_dir, "documents"), ["lang", "n_chars"])
    return docs.groupBy("lang").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"), F.sum("n_chars").alias("n_chars"))
