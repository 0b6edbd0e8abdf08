"""Markdown blocks and graph diagrams in text columns, as rows."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf


def _blocks(text: str) -> Iterator[tuple[str, int, str]]:
    """(kind, level, text) of each block of a Markdown text."""
    lines, i = text.split("\n"), 0
    while i < len(lines):
        line = lines[i]
        if m := re.match(r"(```+|~~~+)\s*(\S*)", line):
            body = []
            while (i := i + 1) < len(lines) and not lines[i].startswith(m[1]):
                body.append(lines[i])
            yield "code", 0, "\n".join(body)
        elif m := re.match(r"(#{1,6})\s+(.*?)\s*#*$", line):
            yield "heading", len(m[1]), m[2]
        elif re.match(r"\s*([-*_])(\s*\1){2,}\s*$", line):
            yield "rule", 0, ""
        elif m := re.match(r"(\s*)([-*+]|\d+[.)])\s+(.*)", line):
            yield ("ordered" if m[2][0].isdigit() else "item"), len(m[1]) // 2 + 1, m[3]
        elif line.startswith(">"):
            yield "quote", 1, line.lstrip("> ")
        elif "|" in line and i + 1 < len(lines) and re.fullmatch(r"\s*\|?\s*:?-+:?\s*(\|\s*:?-+:?\s*)*\|?\s*", lines[i + 1]):
            yield "header", 0, line.strip().strip("|")
            i += 1
            while i + 1 < len(lines) and "|" in lines[i + 1]:
                i += 1
                yield "row", 0, lines[i].strip().strip("|")
        elif line.strip():
            body = [line.strip()]
            while i + 1 < len(lines) and re.match(r"[^\s#>`~|-]", lines[i + 1]) and not re.match(r"\d+[.)]\s", lines[i + 1]):
                i += 1
                body.append(lines[i].strip())
            yield "paragraph", 0, " ".join(body)
        i += 1


@udtf(returnType="ord int, kind string, level int, text string")
class MarkdownBlocks:
    def eval(self, text: str):
        for i, (kind, level, body) in enumerate(_blocks(text or "")):
            yield i, kind, level, body


_SHAPE = r"(\w+)(?:\[\[?\"?([^\]]*?)\"?\]?\]|\(\(?\"?([^)]*?)\"?\)?\)|\{\"?([^}]*?)\"?\})?"
_ARROW = re.compile(rf"\s*{_SHAPE}\s*(-->|---|-\.->|==>|--\s*[^->]+?\s*-->)\s*(?:\|([^|]*)\|)?\s*(?={_SHAPE})")


def _graph(text: str) -> Iterator[tuple[str, str, str, str]]:
    """("node", id, label, "") and ("edge", from, to, label) of a flow diagram."""
    labels: dict[str, str] = {}
    for line in text.split("\n"):
        line = line.split("%%")[0].strip().rstrip(";")
        if not line or re.match(r"(graph|flowchart|subgraph|end|style|classDef|class)\b", line):
            continue
        at = 0
        while m := _ARROW.match(line, at):
            inner = re.match(r"--\s*([^->]+?)\s*-->", m[5])
            to = re.match(rf"\s*{_SHAPE}", line[m.end() :])
            yield "edge", m[1], to[1], (m[6] or (inner[1] if inner else "") or "").strip()
            at = m.end()
        for m in re.finditer(_SHAPE, re.sub(r"-->|---|-\.->|==>|\|[^|]*\|", " ", line)):
            label = next((x for x in m.groups()[1:] if x), None)
            labels[m[1]] = label or labels.get(m[1], m[1])
    for name, label in labels.items():
        yield "node", name, label, ""


@udtf(returnType="part string, source string, target string, label string")
class DiagramParts:
    def eval(self, text: str):
        yield from _graph(text or "")


def markdown_blocks(df: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """(keys, ord, kind, level, text): the blocks of each row's Markdown."""
    return df.lateralJoin(MarkdownBlocks(F.col(text).outer())).select(*keys, "ord", "kind", "level", F.col("text") if text != "text" else F.col("text"))


def diagram_parts(df: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """(keys, part, source, target, label): nodes and edges of each row's diagram."""
    return df.lateralJoin(DiagramParts(F.col(text).outer())).select(*keys, "part", "source", "target", "label")
