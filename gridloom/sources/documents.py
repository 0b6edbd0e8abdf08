"""Nodes of text documents and slides, labelled by intervals.

Every node has its place in document order (``pre``) and that of its last descendant (``post``), within its
file and part: a node stands inside another if its ``pre`` lies behind the other's and up to its ``post``.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator
from xml.etree import ElementTree as ET

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from gridloom.sources.ooxml import open_package, tag

NODES = "file string, part string, path string, parent_path string, ord bigint, type string, text string, style string, format map<string,string>, pre bigint, post bigint, depth int"

#: Element names of the file formats, and the types of their nodes. Fixed values.
TYPES = {
    "p": "paragraph", "r": "run", "tbl": "table", "tr": "tr", "tc": "tc", "sp": "shape", "pic": "picture", "hyperlink": "hyperlink", "grpSp": "group",
    "cxnSp": "connector", "graphicFrame": "frame", "sdt": "sdt", "bookmarkStart": "bookmark", "footnoteReference": "footnote", "commentReference": "comment", "br": "break", "fldSimple": "field",
}
_PARTS = re.compile(r"word/(document|header\d*|footer\d*|footnotes|comments)\.xml|ppt/slides/slide(\d+)\.xml")


class _Open:
    def __init__(self, path: str, parent: str, ord: int, kind: str, pre: int):
        self.path, self.parent, self.ord, self.kind, self.pre = path, parent, ord, kind, pre
        self.text: list[str] = []
        self.counts: dict[str, int] = {}
        self.style, self.format = None, None


def part_nodes(stream, root: str) -> Iterator[tuple]:
    """(path, parent_path, ord, type, text, style, format, pre, post, depth) as nodes end."""
    top = _Open(root, "/", 1, root.strip("/").split("[")[0], 0)
    nodes, number, stack = [top], 0, []
    for event, e in ET.iterparse(stream, ("start", "end")):
        name = tag(e)
        kind = TYPES.get(name)
        if event == "start":
            stack.append(e)
            if kind:
                up, number = nodes[-1], number + 1
                up.counts[kind] = up.counts.get(kind, 0) + 1
                nodes.append(_Open(f"{up.path}/{kind}[{up.counts[kind]}]", up.path, up.counts[kind], kind, number))
            continue
        stack.pop()
        if name == "t":
            for n in nodes[1:]:
                n.text.append(e.text or "")
        elif name in ("pPr", "rPr") and nodes[-1].format is None and stack and TYPES.get(tag(stack[-1])):
            nodes[-1].format = {tag(k): next(iter(k.attrib.values()), "true") for k in e}
            nodes[-1].style = next((next(iter(k.attrib.values()), None) for k in e if tag(k) in ("pStyle", "rStyle")), None)
        elif kind:
            n = nodes.pop()
            yield n.path, n.parent, n.ord, n.kind, "".join(n.text), n.style, n.format or {}, n.pre, number, len(nodes)
            e.clear()
            if stack and not any(TYPES.get(tag(x)) for x in stack):
                stack[-1].clear()
    yield top.path, "/", 1, top.kind, None, None, {}, 0, number, 0


def document_nodes(data: bytes) -> Iterator[tuple]:
    """(part, then as ``part_nodes``) of all parts of a package."""
    z = open_package(io.BytesIO(data))
    for part in sorted(n for n in z.namelist() if _PARTS.fullmatch(n)):
        m = _PARTS.fullmatch(part)
        root = f"/slide[{m[2]}]" if m[2] else "/body" if m[1] == "document" else f"/{m[1]}"
        with z.open(part) as stream:
            for row in part_nodes(stream, root):
                yield part, *row


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Nodes of all text documents and slides at a path or pattern, in any store that Spark reads."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = to_arrow_schema(_parse_datatype_string(NODES))

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([list(x.items()) for x in c] if pa.types.is_map(f.type) else list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, content in zip(b.column("path"), b.column("content")):
                held: list[tuple] = []
                for row in document_nodes(content.as_py()):
                    held.append((file.as_py(), *row))
                    if len(held) == 4096:
                        yield batch(held)
                        held = []
                if held:
                    yield batch(held)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, NODES)
