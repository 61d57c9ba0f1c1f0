"""Tables of mysqldump files, as a Spark data source: ``format("mysqldump")``."""

from __future__ import annotations

import fnmatch
import gzip
import io
import re
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

_VALUE = re.compile(r"NULL|'(?:[^'\\]|\\.|'')*'|-?[0-9]+(?:\.[0-9]+)?(?:[eE][-+]?[0-9]+)?|0x[0-9A-Fa-f]+", re.S)
# What escapes in quoted text stand for.
ESCAPES = {"0": "\0", "n": "\n", "r": "\r", "t": "\t", "b": "\b", "Z": "\x1a"}


def literal(text: str):
    """None, an int or float, or text without its quotes and escapes."""
    if text == "NULL":
        return None
    if text[0] == "'":
        return re.sub(r"\\(.)|''", lambda m: "'" if m[1] is None else ESCAPES.get(m[1], m[1]), text[1:-1], flags=re.S)
    if text.startswith("0x"):
        return bytes.fromhex(text[2:]).decode("latin-1")
    return int(text) if re.fullmatch(r"-?[0-9]+", text) else float(text)


def tuples(statement: str, width: int) -> Iterator[list]:
    """The rows of the VALUES of an INSERT; anything that is no row is an error."""
    at = 0
    while True:
        if statement[at : at + 1] != "(":
            raise ValueError(f"no row at {statement[at : at + 20]!r}")
        row, at = [], at + 1
        while True:
            m = _VALUE.match(statement, at)
            if not m:
                raise ValueError(f"no value at {statement[at : at + 20]!r}")
            row.append(literal(m[0]))
            at = m.end()
            if statement[at] == ",":
                at += 1
                continue
            if statement[at] == ")":
                at += 1
                break
            raise ValueError(f"unreadable at {statement[at : at + 20]!r}")
        if len(row) != width:
            raise ValueError(f"a row has {len(row)} of {width} values")
        yield row
        if statement[at : at + 1] == ",":
            at += 1
            continue
        if statement[at:].strip() in (";", ""):
            return
        raise ValueError(f"residue {statement[at : at + 20]!r}")


def _file_system(path: str):
    """(file system, path in it) of a path on this machine or of any system pyarrow knows."""
    return fs.FileSystem.from_uri(path) if re.match(r"[a-z][a-z0-9+.-]*:", path) else (fs.LocalFileSystem(), path)


def files(path: str) -> list[str]:
    """The dumps under a folder, or those a path with wildcards in its last part names, in order."""
    system, inner = _file_system(path)
    scheme = path[: len(path) - len(inner)] if path.endswith(inner) else ""
    folder, pattern = (inner, "*.sql*") if system.get_file_info(inner).type == fs.FileType.Directory else inner.rsplit("/", 1) if "/" in inner else (".", inner)
    found = [x.path for x in system.get_file_info(fs.FileSelector(folder)) if x.is_file and fnmatch.fnmatchcase(x.base_name, pattern)]
    return sorted(scheme + x for x in found)


def rows(path: str, table: str, wanted: list[str]) -> Iterator[tuple]:
    """The wanted columns of a table's rows, line by line: dumps have one statement per line."""
    system, inner = _file_system(path)
    raw = system.open_input_stream(inner, compression=None)
    opened = io.TextIOWrapper(gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else raw, encoding="utf-8", errors="replace", newline="\n")
    columns: list[str] = []
    inside = False
    with opened as lines:
        for line in lines:
            if line.startswith(f"CREATE TABLE `{table}`"):
                inside, columns = True, []
            elif inside and (m := re.match(r"\s+`([^`]+)`", line)):
                columns.append(m[1])
            elif inside and line.startswith(")"):
                inside = False
            elif line.startswith(f"INSERT INTO `{table}` VALUES "):
                places = [columns.index(c) for c in wanted]
                for row in tuples(line[len(f"INSERT INTO `{table}` VALUES ") :].rstrip("\n"), len(columns)):
                    yield tuple(row[i] for i in places)


class _Part(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, schema, options):
        self.columns, self.options, self.fields = [f.name for f in schema.fields], options, [f.dataType.simpleString() for f in schema.fields]

    def partitions(self):
        return [_Part(p) for p in files(self.options["path"])]

    def read(self, partition):
        fit = {"string": str, "int": int, "bigint": int, "double": float}
        kinds = [fit.get(k, str) for k in self.fields]
        for row in rows(partition.path, self.options["table"], self.columns):
            yield tuple(None if v is None else k(v) for v, k in zip(row, kinds, strict=True))


class MysqlDump(DataSource):
    """One partition per file; options path and table, the schema names the columns wanted."""

    @classmethod
    def name(cls) -> str:
        return "mysqldump"

    def schema(self) -> str:
        raise ValueError("give the columns wanted as a schema")

    def reader(self, schema):
        return _Reader(schema, self.options)


def read(spark: SparkSession, path: str, table: str, schema: str) -> DataFrame:
    spark.dataSource.register(MysqlDump)
    return spark.read.format("mysqldump").schema(schema).option("table", table).load(path)
