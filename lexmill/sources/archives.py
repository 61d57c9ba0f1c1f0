"""Compressed members of dumps: independently decodable bzip2 streams and Zstandard frames."""

from __future__ import annotations

import bz2
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"


def bzip2_members(raw: bytes, most: int) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, content) of each member in order; output over ``most`` bytes is an error."""
    at = 0
    while at < len(raw):
        engine = bz2.BZ2Decompressor()
        content = engine.decompress(raw[at:], most + 1)
        if len(content) > most:
            raise ValueError("a member is larger than allowed")
        if not engine.eof:
            raise ValueError("a member is cut off")
        size = len(raw) - at - len(engine.unused_data)
        yield at, size, content
        at += size


def zstd_frame(raw: bytes, declared: int, most: int) -> bytes:
    """The content of exactly one frame of a declared size."""
    import zstandard

    if raw[:4] != ZSTD_MAGIC:
        raise ValueError("no Zstandard frame")
    if declared > most:
        raise ValueError("a frame is larger than allowed")
    engine = zstandard.ZstdDecompressor().decompressobj()
    content = engine.decompress(raw)
    if len(content) != declared or engine.unused_data:
        raise ValueError("a frame has another size than declared")
    return content


def members(spark: SparkSession, path: str, most: int = 64 << 20) -> DataFrame:
    """path, stream_id, offset, length, content of bzip2 multistream files, in file order."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for name, raw in pdf.itertuples(index=False, name=None):
                for i, (offset, length, content) in enumerate(bzip2_members(bytes(raw), most)):
                    yield pd.DataFrame([(name, i, offset, length, content)], columns=["path", "stream_id", "offset", "length", "content"])

    return files.mapInPandas(run, "path string, stream_id int, offset bigint, length bigint, content binary")


def zstd_members(frames: DataFrame, most: int = 64 << 20) -> DataFrame:
    """id, content of rows (id, raw, declared)."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            yield pd.DataFrame({"id": pdf["id"], "content": [zstd_frame(bytes(r), int(d), most) for r, d in zip(pdf["raw"], pdf["declared"], strict=True)]})

    return frames.select("id", "raw", "declared").mapInPandas(run, f"id {frames.schema['id'].dataType.simpleString()}, content binary")


def read_window(file, offset: int, length: int, most: int) -> bytes:
    """The content of the members in one window of an open file; a window that is no whole members is an error."""
    file.seek(offset)
    raw = file.read(length)
    if len(raw) != length:
        raise ValueError("a window reaches behind the end of its file")
    return b"".join(content for _, _, content in bzip2_members(raw, most)) if raw[:3] == b"BZh" else raw


def windows(index: DataFrame, key: list[str], most: int = 64 << 20) -> DataFrame:
    """key, content of rows (key, path, offset, length): random reads of a dump by its index.

    Every task opens the files of its own rows and reads only their windows, so a
    large dump is spread over tasks; members of a window that comes again in the
    task are decoded once. Paths may name any file system that pyarrow knows.
    """
    shape = ", ".join(f"{c} {index.schema[c].dataType.simpleString()}" for c in key)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        files: dict[str, object] = {}
        last: tuple | None = None
        content = b""
        for pdf in parts:
            rows = []
            for *k, path, offset, length in pdf.itertuples(index=False, name=None):
                if path not in files:
                    system, inner = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
                    files[path] = system.open_input_file(inner)
                if last != (path, offset, length):
                    last, content = (path, offset, length), read_window(files[path], int(offset), int(length), most)
                rows.append((*k, content))
            yield pd.DataFrame(rows, columns=[*key, "content"])

    placed = index.select(*key, "path", F.col("offset").cast("long"), F.col("length").cast("long"))
    return placed.repartition("path", "offset").sortWithinPartitions("path", "offset").mapInPandas(run, f"{shape}, content binary")


def page_of(content, page_id) -> Column:
    """The XML of the page with an id in the decoded members of its window; null for none."""
    text = F.decode(content, "UTF-8")
    pages = F.regexp_extract_all(text, F.lit(r"(?s)<page>.*?</page>"), F.lit(0))
    found = F.filter(pages, lambda p: F.regexp_extract(p, r"<id>([0-9]+)</id>", 1) == page_id.cast("string"))
    return F.try_element_at(found, F.lit(1))
