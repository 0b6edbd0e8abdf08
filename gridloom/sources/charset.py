"""Text in any encoding: marks and declared charsets, delimited files read whole, grids within text, JSON lines."""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.window import Window

#: Byte order marks, and names of charsets with the codecs they stand for; other names are read as UTF-8. Fixed values.
MARKS = ((b"\xef\xbb\xbf", "utf-8"), (b"\xff\xfe", "utf-16-le"), (b"\xfe\xff", "utf-16-be"))
CODECS = {
    "utf-8": "utf-8", "utf8": "utf-8", "us-ascii": "ascii", "ascii": "ascii", "iso-8859-1": "latin-1", "iso8859-1": "latin-1", "iso_8859-1": "latin-1", "latin1": "latin-1", "l1": "latin-1",
    "windows-1252": "cp1252", "cp1252": "cp1252", "win-1252": "cp1252", "ansi": "cp1252", "utf-16": "utf-16-le", "utf-16le": "utf-16-le", "unicode": "utf-16-le", "utf-16be": "utf-16-be",
}
_DECLARED = re.compile(rb"charset\s*=\s*[\"']?([\w.:-]+)", re.I)


def _high() -> dict[int, str]:
    """What windows-1252 prints where Latin-1 has control characters; its unassigned places stay."""
    out = {}
    for b in range(0x80, 0xA0):
        text = bytes([b]).decode("cp1252", "ignore")
        if text:
            out[b] = text
    return out


_PRINTED = _high()


def charset_of(data: bytes, declared: str | None = None) -> tuple[str, int]:
    """(codec, length of the mark): by the mark, else the declared name, else one that the first 2048 bytes declare, else UTF-8."""
    for mark, codec in MARKS:
        if data.startswith(mark):
            return codec, len(mark)
    name = (declared or "").strip().strip("\"'").lower()
    if not name:
        m = _DECLARED.search(data[:2048])
        name = m[1].decode("ascii").lower() if m else ""
    return CODECS.get(name, "utf-8"), 0


def decode(data: bytes | None, declared: str | None = None) -> str | None:
    """The text of some bytes; what is no text becomes a replacement character (? in ASCII)."""
    if data is None:
        return None
    codec, skip = charset_of(data, declared)
    if codec == "cp1252":
        return data.decode("latin-1").translate(_PRINTED)
    if codec == "ascii":
        return data.decode("ascii", "replace").replace("�", "?")
    return data[skip:].decode(codec, "replace")


def _decode_batch(data: pd.Series, declared: pd.Series) -> pd.Series:
    return pd.Series([decode(d if d is None else bytes(d), n) for d, n in zip(data, declared)])


def decoded(data: Column, declared: Column | str | None = None) -> Column:
    """A binary column as text, by ``decode``; ``declared`` is a charset, or a content type that names one."""
    name = declared if isinstance(declared, Column) else F.lit(declared).cast("string")
    of_type = F.regexp_extract(name, r"(?i)charset\s*=\s*[\"']?([\w.:-]+)", 1)
    return pandas_udf(_decode_batch, "string")(data, F.when(of_type != "", of_type).otherwise(F.when(~F.contains(name, F.lit("/")), name)))


def read_text_tables(spark: SparkSession, path: str, delimiter: str = ",", header: bool = True, declared: str | None = None) -> DataFrame:
    """Delimited files of any charset as rows of text, with their ``file``.

    Each file is read whole by one task, as its charset is only known from its bytes; ``delimited`` reads
    large files of a known charset in pieces. With a header the first row of the first file names the columns.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, content in zip(b.column("path"), b.column("content")):
                rows = list(csv.reader(io.StringIO(decode(content.as_py(), declared), newline=""), delimiter=delimiter))
                for at in range(0, len(rows), 10_000):
                    part = rows[at : at + 10_000]
                    yield pa.RecordBatch.from_arrays([pa.array([file.as_py()] * len(part)), pa.array(range(at, at + len(part)), pa.int64()), pa.array(part, pa.list_(pa.string()))], ["file", "row", "cells"])

    rows = spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "file string, row bigint, cells array<string>")
    first = rows.where("row = 0").orderBy("file").select("cells").first()  # of the files' first rows the first
    width = len(first.cells) if first else 0
    names = list(first.cells) if first and header else [f"_c{i}" for i in range(width)]
    return rows.where(F.col("row") >= int(header)).select("file", *[F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(names)])


def grid_rows(df: DataFrame, text: str, keys: list[str], field: str = ",", row: str = ";") -> DataFrame:
    """Keys, ``row`` (from 0) and ``cells`` of a grid written in a text, such as ``a, b; 1, 2``.

    Quoted cells may hold separators, and a doubled quote for one, and keep what stands behind the quote;
    others are trimmed. Rows without any filled cell are left out, and do not count.
    """
    f, r = re.escape(field), re.escape(row)
    quoted = rf'[^\S{f}{r}]*"(?:[^"]|"")*(?:"[^{f}{r}]*|\z)'
    body = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), "^﻿", "")
    tokens = F.regexp_extract_all(body, F.lit(rf"(?s)((?:{quoted}|[^{f}{r}]*)(?:[{f}{r}]|\z))"), F.lit(1))
    # behind a last cell without a separator the pattern finds one more, empty
    ended = (F.size(tokens) > 1) & (F.element_at(tokens, -1) == "") & ~F.rlike(F.element_at(tokens, -2), F.lit(rf"[{f}{r}]\z"))
    cut = df.select(*keys, F.posexplode(F.when(ended, F.slice(tokens, F.lit(1), F.size(tokens) - 1)).otherwise(tokens)).alias("at", "token"))
    ends, bare = F.col("token").endswith(row), F.regexp_replace("token", rf"[{f}{r}]\z", "")
    if row == "\n":
        bare = F.when(F.rlike(bare, F.lit('(?s)^\\s*"')), F.regexp_replace(bare, r"\r\z", "")).otherwise(F.replace(bare, F.lit("\r"), F.lit("")))
    inner = F.regexp_extract(bare, r'(?s)^\s*"((?:[^"]|"")*)(?:"|\z)(.*)\z', 1)
    tail = F.regexp_extract(bare, r'(?s)^\s*"((?:[^"]|"")*)(?:"|\z)(.*)\z', 2)
    cell = F.when(F.rlike(bare, F.lit(r'(?s)^\s*"')), F.concat(F.replace(inner, F.lit('""'), F.lit('"')), tail)).otherwise(F.regexp_replace(bare, r"^\s+|\s+$", ""))
    before = F.coalesce(F.sum(ends.cast("int")).over(Window.partitionBy(*keys).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = cut.select(*keys, "at", cell.alias("cell"), before.alias("__row"))
    whole = placed.groupBy(*keys, "__row").agg(F.array_sort(F.collect_list(F.struct("at", "cell"))).alias("c")).select(*keys, "__row", F.transform("c", lambda x: x["cell"]).alias("cells"))
    filled = whole.where(F.exists("cells", lambda x: x != ""))
    number = F.row_number().over(Window.partitionBy(*keys).orderBy("__row")) - 1
    return filled.select(*keys, number.cast("bigint").alias("row"), "cells")


def json_lines(df: DataFrame, warnings: Column | None = None) -> DataFrame:
    """One column ``value``: every row in an envelope, {"success": true, "data": {...}}, with its warnings if there are any."""
    data = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    fields = [F.lit(True).alias("success"), data.alias("data")]
    if warnings is not None:
        fields.append(F.when(F.size(warnings) > 0, warnings).alias("warnings"))
    return df.select(F.to_json(F.struct(*fields)).alias("value"))
