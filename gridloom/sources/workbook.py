"""Workbooks as a Spark data source, cells of workbooks in any store that Spark reads, and a workbook writer.

``register(spark)`` enters the format "workbook": ``spark.read.format("workbook").load(folder)`` gives the
cells of all sheets, a task for each file and sheet; with ``header`` the rows of a sheet as a table.
``df.write.format("workbook").mode("overwrite").save(folder)`` writes a file a task.
"""

from __future__ import annotations

import datetime as dt
import fnmatch
import io
import os
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage
from pyspark.sql.types import BooleanType, DateType, DecimalType, DoubleType, FloatType, IntegralType, StringType, StructField, StructType, TimestampNTZType, TimestampType, _parse_datatype_string

from gridloom.sources.ooxml import Cell, Workbook, write_package

CELLS = "file string, sheet string, row bigint, col bigint, kind string, num double, text string, formula string, moment timestamp_ntz, merge string"
BATCH = 8192  # rows of an Arrow batch


def register(spark: SparkSession) -> None:
    """Enter the format "workbook". Filters are pushed to it, which is a setting of the session."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WorkbookSource)


def file_system(path: str) -> tuple[pa.fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pa.fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)
    return pa.fs.LocalFileSystem(), os.path.abspath(path)


def workbook_files(path: str) -> tuple[pa.fs.FileSystem, list[str]]:
    """Workbooks at a file, in a folder, or by a pattern in the last part; hidden and unfinished files are none."""
    fs, at = file_system(path)
    folder, name = at.rsplit("/", 1)
    pattern = name if any(ch in name for ch in "*?[") else None
    info = fs.get_file_info(folder if pattern else at)
    if info.type == pa.fs.FileType.File:
        return fs, [at]
    if info.type == pa.fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = fs.get_file_info(pa.fs.FileSelector(folder if pattern else at))
    good = [f.path for f in found if f.type == pa.fs.FileType.File and f.base_name[:1] not in "._~" and (fnmatch.fnmatch(f.base_name, pattern) if pattern else f.base_name.lower().endswith((".xlsx", ".xlsm")))]
    return fs, sorted(good)


@dataclass
class Part(InputPartition):
    file: str
    sheet: str


class WorkbookSource(DataSource):
    """Options: ``path``; ``sheet`` (a name; all by default); ``header`` (the first row names the columns, and rows
    are a table: texts, or the types of the schema given, whose columns alone are converted); ``merged``
    (cells know their merged range); ``fillMerged`` (covered cells take its value). To write: ``sheetName``,
    ``header``, ``maxRows`` of a sheet, ``formulas`` (texts that begin with = are formulas)."""

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> StructType | str:
        if not _true(self.options.get("header")):
            return CELLS
        fs, files = workbook_files(self.options["path"])
        for file in files:
            with fs.open_input_file(file) as f:
                book = Workbook(f)
                for sheet in book.sheets:
                    if self.options.get("sheet", sheet) == sheet:
                        return StructType([StructField(n, StringType()) for n in _header(book, sheet)])
        raise ValueError("no sheet to take the columns from; give a schema")

    def reader(self, schema: StructType) -> DataSourceReader:
        return WorkbookReader(schema, dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return WorkbookWriter(schema, dict(self.options), overwrite)


def _true(x: str | None) -> bool:
    return str(x).lower() == "true"


def _header(book: Workbook, sheet: str) -> dict[str, int]:
    """Column names of the first row, with their numbers; of equal names the first counts."""
    names: dict[str, int] = {}
    for c in book.cells(sheet, last=1):
        if c.text:
            names.setdefault(c.text, c.col)
    return names


class WorkbookReader(DataSourceReader):
    """Rows of ``Part``s. Filters on file and sheet leave tasks out, those on row and column cells; reading ends at the last row wanted."""

    def __init__(self, schema: StructType, options: dict[str, str]):
        options = {k.lower(): v for k, v in options.items()}
        self.fields, self.path = [(f.name, f.dataType) for f in schema.fields], options["path"]
        self.table = _true(options.get("header"))
        self.sheets = {options["sheet"]} if "sheet" in options else None
        self.files: set[str] | None = None
        self.first, self.last, self.columns = 1, None, None
        self.merged, self.fill = _true(options.get("merged")), _true(options.get("fillmerged"))

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            name = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else ""
            values = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            if self.table or name not in ("file", "sheet", "row", "col"):
                yield f
            elif name in ("file", "sheet") and values is not None:
                held = self.sheets if name == "sheet" else self.files
                setattr(self, "sheets" if name == "sheet" else "files", values if held is None else held & values)
            elif name == "col" and values is not None:
                self.columns = values if self.columns is None else self.columns & values
            elif name == "row" and isinstance(f, EqualTo):
                self._rows(f.value, f.value)
            elif name == "row" and isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                self._rows(f.value + isinstance(f, GreaterThan), None)
            elif name == "row" and isinstance(f, (LessThan, LessThanOrEqual)):
                self._rows(1, f.value - isinstance(f, LessThan))
            else:
                yield f

    def _rows(self, first: int, last: int | None) -> None:
        self.first = max(self.first, first)
        self.last = last if self.last is None else self.last if last is None else min(self.last, last)

    def partitions(self) -> list[Part]:
        """A part for each file and sheet; only the files' directories are read for it, several at a time."""
        fs, files = workbook_files(self.path)

        def sheets(file: str) -> list[Part]:
            with fs.open_input_file(file) as f:
                return [Part(file, s) for s in Workbook(f).sheets if self.sheets is None or s in self.sheets]

        chosen = [f for f in files if self.files is None or f in self.files]
        with ThreadPoolExecutor(16) as pool:
            return [p for own in pool.map(sheets, chosen) for p in own] or [Part("", "")]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        if not partition.file:
            return
        fs, _ = file_system(self.path)
        schema = to_arrow_schema(StructType([StructField(n, t) for n, t in self.fields]))
        with fs.open_input_file(partition.file) as f:
            book = Workbook(f)
            rows = self._table(book, partition.sheet) if self.table else self._cells(book, partition)
            held: list[tuple] = []
            for row in rows:
                held.append(row)
                if len(held) == BATCH:
                    yield _batch(held, schema)
                    held = []
            if held:
                yield _batch(held, schema)

    def _cells(self, book: Workbook, part: Part) -> Iterator[tuple]:
        names = [n for n, _ in self.fields]
        every = CELLS.split(", ")
        take = [[c.split()[0] for c in every].index(n) for n in names]
        for c in book.cells(part.sheet, self.first, self.last, self.columns, self.merged, self.fill):
            row = (part.file, part.sheet, *c)
            yield tuple(row[i] for i in take)

    def _table(self, book: Workbook, sheet: str) -> Iterator[tuple]:
        names = {n.lower(): col for n, col in reversed(_header(book, sheet).items())}
        places = [names.get(n.lower()) for n, _ in self.fields]
        kinds = [t for _, t in self.fields]
        for _, row in book.rows(sheet, first=2, columns={p for p in places if p}, fill=self.fill):
            values = {c.col: c for c in row}
            yield tuple(_value(values.get(p), t) for p, t in zip(places, kinds))


def _value(c: Cell | None, kind):
    """A cell as a value of the column's type; None where it is none."""
    if c is None or c.kind in ("blank", "error"):
        return None
    try:
        if isinstance(kind, StringType):
            return c.text
        if isinstance(kind, BooleanType):
            return {"TRUE": True, "FALSE": False}.get((c.text or "").upper())
        if isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
            at = c.moment or dt.datetime.fromisoformat(c.text)
            return at.date() if isinstance(kind, DateType) else at.replace(tzinfo=dt.timezone.utc) if isinstance(kind, TimestampType) else at
        if isinstance(kind, IntegralType):
            return int(c.text) if c.kind == "number" and c.text.lstrip("-").isdigit() else int(c.num if c.num is not None else float(c.text))
        if isinstance(kind, (DoubleType, FloatType)):
            return c.num if c.num is not None else float(c.text)
        if isinstance(kind, DecimalType):
            from decimal import Decimal

            return Decimal(c.text).quantize(Decimal(1).scaleb(-kind.scale))
    except (ValueError, ArithmeticError):
        return None
    raise TypeError(f"a workbook has no cells of type {kind.simpleString()}")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, f.type) for column, f in zip(zip(*rows), schema)], schema=schema)


@dataclass
class Written(WriterCommitMessage):
    name: str
    rows: int


class WorkbookWriter(DataSourceArrowWriter):
    """A file a task under a hidden name; ``commit`` gives the files their names, ``abort`` deletes them."""

    def __init__(self, schema: StructType, options: dict[str, str], overwrite: bool):
        options = {k.lower(): v for k, v in options.items()}
        wrong = [f.name for f in schema.fields if not isinstance(f.dataType, (StringType, BooleanType, DateType, TimestampType, TimestampNTZType, IntegralType, DoubleType, FloatType, DecimalType))]
        if wrong:
            raise TypeError(f"no cells for the types of {', '.join(wrong)}")
        self.path, self.overwrite, self.job = options["path"], overwrite, uuid.uuid4().hex
        self.columns = None if str(options.get("header", "true")).lower() == "false" else [f.name for f in schema.fields]
        self.sheet, self.most, self.formulas = options.get("sheetname", "Sheet1"), int(options.get("maxrows", 1_048_576)), _true(options.get("formulas"))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        fs, folder = file_system(self.path)
        fs.create_dir(folder, recursive=True)
        context = TaskContext.get()
        name = f"part-{context.partitionId():05d}-{context.taskAttemptId()}-{self.job}.xlsx"
        rows = (row for batch in iterator for row in zip(*(c.to_pylist() for c in batch.columns)))
        with fs.open_output_stream(f"{folder}/_{name}") as out:
            n = write_package(out, self.columns, rows, self.sheet, self.most, self.formulas)
        return Written(name, n)

    def commit(self, messages: list[Written | None]) -> None:
        fs, folder = file_system(self.path)
        if self.overwrite:
            for f in fs.get_file_info(pa.fs.FileSelector(folder, allow_not_found=True)):
                if f.type == pa.fs.FileType.File and f.base_name.startswith("part-") and f.base_name.endswith(".xlsx"):
                    fs.delete_file(f.path)
        for m in messages:
            if m is not None:
                fs.move(f"{folder}/_{m.name}", f"{folder}/{m.name}")
        self._sweep(fs, folder)

    def abort(self, messages: list[Written | None]) -> None:
        fs, folder = file_system(self.path)
        self._sweep(fs, folder)

    def _sweep(self, fs: pa.fs.FileSystem, folder: str) -> None:
        """Delete what tasks of this job have left that failed or ran twice."""
        for f in fs.get_file_info(pa.fs.FileSelector(folder, allow_not_found=True)):
            if f.base_name.startswith("_part-") and f.base_name.endswith(f"-{self.job}.xlsx"):
                fs.delete_file(f.path)


def read_workbooks(spark: SparkSession, path: str, merged: bool = False) -> DataFrame:
    """Cells of all workbooks at a path or pattern, through Spark's own reader of binary files: for stores that only Spark reads."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(_parse_datatype_string(CELLS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, content in zip(b.column("path"), b.column("content")):
                book = Workbook(io.BytesIO(content.as_buffer()))
                for sheet in book.sheets:
                    held: list[tuple] = []
                    for c in book.cells(sheet, merged=merged):
                        held.append((file.as_py(), sheet, *c))
                        if len(held) == BATCH:
                            yield _batch(held, schema)
                            held = []
                    if held:
                        yield _batch(held, schema)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, CELLS)


def read_parts(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Sheets (file, sheet) and defined names (file, name, refers) of all workbooks at a path or pattern."""
    kinds = "kind string, file string, name string, refers string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, content in zip(b.column("path"), b.column("content")):
                book = Workbook(io.BytesIO(content.as_buffer()))
                rows = [("sheet", file.as_py(), s, None) for s in book.sheets] + [("name", file.as_py(), n, r) for n, r in book.names]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], ["kind", "file", "name", "refers"])

    parts = spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, kinds)
    return parts.where("kind = 'sheet'").select("file", F.col("name").alias("sheet")), parts.where("kind = 'name'").select("file", "name", "refers")


def sheet_table(cells: DataFrame, sheet: str, columns: list[str], header_row: int = 1) -> DataFrame:
    """A sheet's cells as a wide table with the given column names, one row for each row below the header."""
    rows = cells.where((F.col("sheet") == sheet) & (F.col("row") > header_row))
    return rows.groupBy("file", "row").agg(*[F.max(F.when(F.col("col") == i + 1, F.col("text"))).alias(c) for i, c in enumerate(columns)])


def write_workbook(rows: list[tuple], columns: list[str], sheet: str = "Sheet1") -> bytes:
    """A workbook of a report's rows, as bytes; tables are written by the data source."""
    out = io.BytesIO()
    write_package(out, columns, rows, sheet)
    return out.getvalue()
