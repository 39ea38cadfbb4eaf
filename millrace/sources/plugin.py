"""A Python data source for dataset folders, with partitions, a schema, equalities that are tried in the source, and a scan limit that is cut before reading.

`register(spark)` makes it known as format `millrace_dataset`. Options: path (a file, or a folder of Parquet or JSON Lines
files), subset and split (the folder below path and the beginning of file names), scan_limit (rows that are read at
most, in the order of files and rows), where (JSON list of pairs of column and value), split_bytes (of JSON Lines).

A partition is a row group of a Parquet file, or a range of bytes of a JSON Lines file. scan_limit is known before a
row is read: footers tell how many rows a group has, and of JSON Lines the driver reads as many lines as the limit.
Equalities in `where` are tried on a row group's statistics first, then on its rows, before anything goes to Spark. Filters of a query
stay with Spark: it keeps a reader with a frame, so what a reader took from one query would still hold in the next one (Spark 4.1).
Each row has its place (column `place`, if the schema names it): the file's number and the row's number in it, so that
a limit after the filter means the same rows every time.

A row whose column is null, or that lacks it, equals no value. An empty folder is an error, a file without rows is not.
A line that is not a JSON object is an error that names the file and the place.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema
from pyspark.sql.types import LongType, StructType

from .readers import SourceSpec

NAME = "millrace_dataset"
#: The number of a file is above this many bits of a row's place.
FILE_BITS = 40
SUFFIXES = (".parquet", ".pq", ".jsonl")


def _store(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pyarrow.fs.LocalFileSystem(), path)


def dataset_files(path: str, subset: str | None = None, split: str | None = None) -> list[str]:
    """Files of a dataset in order of name: path itself, or what lies below path/subset and begins with split."""
    store, root = _store(path)
    info = store.get_file_info(root)
    if info.type == pyarrow.fs.FileType.File:
        return [root]
    folder = f"{root.rstrip('/')}/{subset}" if subset else root
    if store.get_file_info(folder).type != pyarrow.fs.FileType.Directory:
        raise FileNotFoundError(f"no folder {folder}")
    found = [f.path for f in store.get_file_info(pyarrow.fs.FileSelector(folder, recursive=not split)) if f.type == pyarrow.fs.FileType.File]
    found = sorted(f for f in found if f.endswith(SUFFIXES) and f.rpartition("/")[2].startswith(split or "") and not f.rpartition("/")[2].startswith(("_", ".")))
    if not found:
        raise FileNotFoundError(f"no {', '.join(SUFFIXES)} files in {folder}" + (f" that begin with {split}" if split else ""))
    return found


@dataclass
class Piece(InputPartition):
    """Rows of one file: a row group, or bytes from a line's beginning on. rows: how many of them are read, None for all."""

    file: str
    number: int  #: of the file
    group: int | None
    low: int  #: first row of the group, or first byte
    high: int | None
    rows: int | None

    def __init__(self, file: str, number: int, group: int | None, low: int, high: int | None, rows: int | None):
        self.file, self.number, self.group, self.low, self.high, self.rows = file, number, group, low, high, rows


def _lines_until(store, file: str, most: int) -> tuple[int, int]:
    """Lines with something in them, at most `most`, and the byte where the last of them ends."""
    n = at = 0
    with store.open_input_stream(file) as raw:
        rest = b""
        while n < most and (part := raw.read(1 << 20)):
            rest += part
            *lines, rest = rest.split(b"\n")
            for line in lines:
                at += len(line) + 1
                n += bool(line.strip())
                if n == most:
                    return n, at
        if n < most and rest.strip():
            return n + 1, at + len(rest)
    return n, at


def plan(files: list[str], scan_limit: int | None, split_bytes: int, store) -> list[Piece]:
    """Pieces of all files in order; with a limit, the last of them is cut to the rows that are left."""
    out, left = [], scan_limit
    for number, file in enumerate(files):
        if left == 0:
            break
        if file.endswith(".jsonl"):
            size, most = store.get_file_info(file).size, None
            if left is not None:
                most, size = _lines_until(store, file, left)
                left -= most
            out += [Piece(file, number, None, low, min(low + split_bytes, size), None) for low in range(0, size, split_bytes)]
            continue
        with store.open_input_file(file) as f:
            meta = pq.read_metadata(f)
        row = 0
        for group in range(meta.num_row_groups):
            rows = meta.row_group(group).num_rows
            if left is not None:
                rows = min(rows, left)
                left -= rows
            if rows:
                out.append(Piece(file, number, group, row, None, rows))
            row += meta.row_group(group).num_rows
    return out


def _schema_of(files: list[str], store) -> pa.Schema:
    """Of Parquet from the first footer; of JSON Lines from the first megabytes, as their columns in order of name."""
    if not files[0].endswith(".jsonl"):
        with store.open_input_file(files[0]) as f:
            return pq.read_schema(f).remove_metadata()
    import pyarrow.json

    with store.open_input_stream(files[0]) as raw:
        head = raw.read(4 << 20)
    head = head[: head.rfind(b"\n") + 1] or head
    schema = pyarrow.json.read_json(pa.BufferReader(head)).schema if head.strip() else pa.schema([])
    return pa.schema(sorted(schema, key=lambda field: field.name))


class DatasetReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.options, self.schema = options, schema
        self.equal: list[tuple[str, object]] = [tuple(x) for x in json.loads(options.get("where") or "[]")]

    def partitions(self) -> list[Piece]:
        files = dataset_files(self.options["path"], self.options.get("subset"), self.options.get("split"))
        limit = self.options.get("scan_limit")
        pieces = plan(files, int(limit) if limit else None, int(self.options.get("split_bytes") or 32 << 20), _store(self.options["path"])[0])
        return pieces or [Piece(files[0], 0, None, 0, 0, 0)]

    def read(self, piece: Piece) -> Iterator[pa.RecordBatch]:
        wanted = to_arrow_schema(self.schema)
        store = _store(self.options["path"])[0]
        batches = self._lines(store, piece) if piece.group is None else self._group(store, piece)
        for table, places in batches:
            keep = pa.array([True] * table.num_rows) if not self.equal else None
            for column, value in self.equal:
                same = _equals(table.column(column), value) if column in table.column_names else pa.array([False] * table.num_rows)
                keep = same if keep is None else pc.and_(keep, same)
            columns = [places if f.name == "place" else table.column(f.name).cast(f.type) if f.name in table.column_names else pa.nulls(table.num_rows, f.type) for f in wanted]
            for batch in pa.table(columns, schema=wanted).filter(pc.fill_null(keep, False)).to_batches(10_000):
                if batch.num_rows:
                    yield batch

    def _group(self, store, piece: Piece) -> Iterator[tuple[pa.Table, pa.Array]]:
        with store.open_input_file(piece.file) as f:
            file = pq.ParquetFile(f)
            there = set(file.schema_arrow.names)
            if _ruled_out(file.metadata.row_group(piece.group), self.equal):
                return
            columns = sorted(there & ({x.name for x in self.schema} | {c for c, _ in self.equal}))
            at = 0
            for batch in file.iter_batches(8192, row_groups=[piece.group], columns=columns):
                batch = batch.slice(0, piece.rows - at)
                if not batch.num_rows:
                    return
                first = (piece.number << FILE_BITS) + piece.low + at
                yield pa.Table.from_batches([batch]), pa.array(range(first, first + batch.num_rows), pa.int64())
                at += batch.num_rows

    def _lines(self, store, piece: Piece) -> Iterator[tuple[pa.Table, pa.Array]]:
        """Lines that begin in the range; a place is the byte where a line begins."""
        wanted = to_arrow_schema(self.schema)
        own = pa.schema([f for f in wanted if f.name != "place"] + [pa.field(c, pa.infer_type([v])) for c, v in self.equal if c not in self.schema.names])
        with store.open_input_file(piece.file) as f:
            at = piece.low
            if at:
                f.seek(at - 1)
                at += _skip_line(f)
            else:
                f.seek(0)
            rows, places = [], []
            for line in _lines_from(f):
                if at >= (piece.high or 0):
                    break
                if line.strip():
                    try:
                        row = json.loads(line)
                    except ValueError as error:
                        raise ValueError(f"{piece.file}, byte {at}: {error}") from None
                    if not isinstance(row, dict):
                        raise ValueError(f"{piece.file}, byte {at}: not an object")
                    rows.append(row)
                    places.append((piece.number << FILE_BITS) + at)
                at += len(line) + 1
                if len(rows) == 4096:
                    yield pa.Table.from_pylist(rows, own), pa.array(places, pa.int64())
                    rows, places = [], []
            if rows:
                yield pa.Table.from_pylist(rows, own), pa.array(places, pa.int64())


def _skip_line(f) -> int:
    """Reads on to the end of the line that holds the byte before; how many bytes of the range that were."""
    skipped = -1
    while part := f.read(1 << 16):
        if (end := part.find(b"\n")) >= 0:
            f.seek(f.tell() - len(part) + end + 1)
            return skipped + end + 1
        skipped += len(part)
    return skipped


def _lines_from(f) -> Iterator[bytes]:
    rest: list[bytes] = []
    while part := f.read(1 << 18):
        *lines, last = part.split(b"\n")
        if lines:
            yield b"".join([*rest, lines[0]])
            yield from lines[1:]
            rest = [last]
        else:
            rest.append(last)
    if last := b"".join(rest):
        yield last


def _equals(column: pa.ChunkedArray, value: object) -> pa.Array:
    """As Python compares: numbers and truth values with each other, texts with texts, nothing else is equal."""
    kind = column.type
    number = pa.types.is_integer(kind) or pa.types.is_floating(kind) or pa.types.is_decimal(kind) or pa.types.is_boolean(kind)
    text = pa.types.is_string(kind) or pa.types.is_large_string(kind)
    if isinstance(value, str) != text or not (number or text):
        return pa.array([False] * len(column))
    if pa.types.is_boolean(kind):
        column = column.cast(pa.int8())
    found = pc.equal(column, pa.scalar(value + 0 if isinstance(value, bool) else value))
    return found.combine_chunks() if isinstance(found, pa.ChunkedArray) else found


def _ruled_out(group, equal: list[tuple[str, object]]) -> bool:
    """Whether the statistics of a row group show that no row has a value."""
    for k in range(group.num_columns):
        column = group.column(k)
        stats = column.statistics
        for name, value in equal:
            if column.path_in_schema == name and stats is not None and stats.has_min_max and isinstance(stats.min, type(value)) and not isinstance(value, bool) and not stats.min <= value <= stats.max:
                return True
    return False


class Dataset(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> StructType:
        files = dataset_files(self.options["path"], self.options.get("subset"), self.options.get("split"))
        return from_arrow_schema(_schema_of(files, _store(self.options["path"])[0])).add("place", LongType())

    def reader(self, schema: StructType) -> DatasetReader:
        return DatasetReader(dict(self.options), schema)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Dataset)


def read_dataset(spark: SparkSession, path: str, spec: SourceSpec | None = None, schema: StructType | None = None, **options: object) -> DataFrame:
    """The rows of a dataset folder as a spec bounds them: scan_limit before, the filter while, and limit after reading."""
    register(spark)
    reader = spark.read.format(NAME).option("path", path).options(**{k: v for k, v in options.items() if v is not None})
    if schema is not None:
        reader = reader.schema(schema)
    if spec is None:
        return reader.load()
    for key, value in (("subset", spec.subset), ("split", spec.split if spec.subset or spec.split != "train" else None), ("scan_limit", spec.scan_limit)):
        reader = reader.option(key, value) if value is not None else reader
    if spec.where:
        reader = reader.option("where", json.dumps([list(x) for x in spec.where]))
    df = reader.load()
    return df.orderBy(F.col("place")).limit(spec.limit) if spec.limit else df
