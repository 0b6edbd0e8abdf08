"""Pull parsing of office packages, and streamed writing of workbooks.

Parts are read element by element, so a sheet's memory is that of a row; only the texts that cells share
and the kinds of the number formats are held whole.
"""

from __future__ import annotations

import datetime as dt
import re
import zipfile
from collections.abc import Iterable, Iterator
from typing import NamedTuple
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape

MOST_BYTES = 2 << 30  # unpacked size of a file beyond which it is refused
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"

#: Built-in number formats that show dates, and times of day. Fixed values of the file format.
DATE_FORMATS = {14, 15, 16, 17, 22, 27, 28, 29, 30, 31, 36, 50, 51, 52, 53, 54, 57, 58}
TIME_FORMATS = {18, 19, 20, 21, 32, 33, 34, 35, 45, 46, 47, 55, 56}


class Cell(NamedTuple):
    """A stored cell. ``kind`` is number, date, time, string, boolean, error or blank; ``text`` is what is
    stored, for dates in ISO form; ``merge`` is the merged range that the cell lies in."""

    row: int
    col: int
    kind: str
    num: float | None
    text: str | None
    formula: str | None
    moment: dt.datetime | None
    merge: str | None


def tag(e: ET.Element) -> str:
    return e.tag.rsplit("}", 1)[-1]


def column_number(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + ord(ch) - 64
    return n


def column_letters(n: int) -> str:
    out = ""
    while n:
        n, r = divmod(n - 1, 26)
        out = chr(65 + r) + out
    return out


def from_serial(n: float, date1904: bool = False) -> dt.datetime | None:
    """The moment of a date serial, to a thousandth of a second. The 1900 system has a 29 February 1900, number 60,
    that no calendar has: it becomes the 28th, and days before it count one less. None beyond the calendar."""
    if date1904:
        n += 1462
    elif 1 <= n < 60:
        n += 1
    try:
        return dt.datetime(1899, 12, 30) + dt.timedelta(milliseconds=round(n * 86_400_000))
    except OverflowError:
        return None


def to_serial(d: dt.date | dt.datetime) -> float | None:
    """The serial in the 1900 system; None before it begins."""
    at = d if isinstance(d, dt.datetime) else dt.datetime(d.year, d.month, d.day)
    n = (at - dt.datetime(1899, 12, 30)) / dt.timedelta(days=1)
    n = n - 1 if n < 61 else n
    return n if n >= 1 else None


def format_kind(code: str) -> str:
    """What a number format's code shows: date, time or number. Quoted and bracketed parts say nothing, and a code
    with digits is a number's, but for fractions of seconds."""
    if re.search(r"\[(h+|m+|s+)\]", code, re.I):
        return "time"  # elapsed
    bare = re.sub(r'"[^"]*"|\\.|\[[^\]]*\]', "", code.split(";")[0]).lower()
    bare = re.sub(r"s\.0+", "s", bare)
    if re.search(r"[0#?]", bare) or bare in ("general", "@"):
        return "number"
    if re.search(r"[yd]", bare):
        return "date"
    if re.search(r"[hs]", bare):
        return "time"
    return "date" if "m" in bare else "number"


def unescaped(text: str) -> str:
    return re.sub(r"_x([0-9A-Fa-f]{4})_", lambda m: chr(int(m[1], 16)), text) if "_x" in text else text


def escaped(text: str) -> str:
    """Text as an element's content; characters that XML has no place for, or would change, by their codes."""
    text = re.sub(r"_(?=x[0-9A-Fa-f]{4}_)", "_x005F_", text)
    return escape(re.sub(r"[\x00-\x08\x0b-\x1f\ufffe\uffff]", lambda m: f"_x{ord(m[0]):04X}_", text))


def open_package(file) -> zipfile.ZipFile:
    z = zipfile.ZipFile(file)
    if sum(i.file_size for i in z.infolist()) > MOST_BYTES:
        raise ValueError("the unpacked file is too large")
    return z


def elements(z: zipfile.ZipFile, part: str, wanted: set[str]) -> Iterator[ET.Element]:
    """Elements of these names as they end; each is emptied, and its parent with it, when the next one is asked for."""
    with z.open(part) as stream:
        path: list[ET.Element] = []
        for event, e in ET.iterparse(stream, ("start", "end")):
            if event == "start":
                path.append(e)
                continue
            path.pop()
            if tag(e) in wanted:
                yield e
                e.clear()
                if path and not any(tag(p) in wanted for p in path):
                    path[-1].clear()


def string_item(e: ET.Element) -> str:
    """The text of a shared or inline string; phonetic hints are not part of it."""
    out = []
    for k in e:
        if tag(k) == "t":
            out.append(k.text or "")
        elif tag(k) == "r":
            out += [t.text or "" for t in k if tag(t) == "t"]
    return unescaped("".join(out))


class Workbook:
    """An open workbook: its sheets in order, and their cells."""

    def __init__(self, file):
        self.zip = open_package(file)
        names = set(self.zip.namelist())
        targets = {r.get("Id"): r.get("Target") for r in ET.fromstring(self.zip.read("xl/_rels/workbook.xml.rels"))}
        book = ET.fromstring(self.zip.read("xl/workbook.xml"))
        parts = [(s.get("name"), targets.get(s.get(_REL), "")) for holder in book if tag(holder) == "sheets" for s in holder]
        self.sheets = {n: t.lstrip("/") if t.startswith("/") else f"xl/{t}" for n, t in parts}
        self.sheets = {n: t for n, t in self.sheets.items() if t in names and "worksheets" in t}
        self.names = [(d.get("name"), d.text or "") for holder in book if tag(holder) == "definedNames" for d in holder]
        self.date1904 = any(p.get("date1904") in ("1", "true") for p in book if tag(p) == "workbookPr")
        self._names = names
        self._shared: list[str] | None = None
        self._kinds: list[str] | None = None

    def shared(self) -> list[str]:
        if self._shared is None:
            part = "xl/sharedStrings.xml"
            self._shared = [string_item(e) for e in elements(self.zip, part, {"si"})] if part in self._names else []
        return self._shared

    def kinds(self) -> list[str]:
        """Number, date or time for each cell style."""
        if self._kinds is None:
            self._kinds, codes = [], {}
            root = ET.fromstring(self.zip.read("xl/styles.xml")) if "xl/styles.xml" in self._names else []
            for group in root:
                if tag(group) == "numFmts":
                    codes = {int(f.get("numFmtId")): f.get("formatCode", "") for f in group}
            for group in root:
                if tag(group) == "cellXfs":
                    for x in group:
                        i = int(x.get("numFmtId", 0))
                        self._kinds.append(format_kind(codes[i]) if i in codes else "date" if i in DATE_FORMATS else "time" if i in TIME_FORMATS else "number")
        return self._kinds

    def merges(self, sheet: str) -> list[tuple[int, int, int, int, str]]:
        """(first row, first column, last row, last column, range) of merged cells; they stand behind the cells."""
        found = []
        for e in elements(self.zip, self.sheets[sheet], {"mergeCell", "row"}):
            m = re.fullmatch(r"([A-Z]+)(\d+):([A-Z]+)(\d+)", e.get("ref", "")) if tag(e) == "mergeCell" else None
            if m:
                found.append((int(m[2]), column_number(m[1]), int(m[4]), column_number(m[3]), m[0]))
        return sorted(found)

    def cells(self, sheet: str, first: int = 1, last: int | None = None, columns: set[int] | None = None, merged: bool = False, fill: bool = False) -> Iterator[Cell]:
        """The cells of ``rows``."""
        for _, row in self.rows(sheet, first, last, columns, merged, fill):
            yield from row

    def rows(self, sheet: str, first: int = 1, last: int | None = None, columns: set[int] | None = None, merged: bool = False, fill: bool = False) -> Iterator[tuple[int, list[Cell]]]:
        """(number, stored cells) of rows ``first`` to ``last``; reading ends behind the last row.

        ``columns`` leaves others out. With ``merged`` cells know their merged range; ``fill`` gives the
        covered cells the value of the range's first one, also in rows that the file leaves out.
        """
        boxes = self.merges(sheet) if merged or fill else []
        if not fill:
            for number, row in self._stored(sheet, first, last, columns):
                near = [b for b in boxes if b[0] <= number <= b[2]]
                yield number, [c._replace(merge=next((b[4] for b in near if b[1] <= c.col <= b[3]), None)) for c in row] if near else row
            return
        values: dict[str, Cell] = {}

        def filled(number: int, row: list[Cell]) -> tuple[int, list[Cell]]:
            by_col = {c.col: c for c in row}
            for b in boxes:
                if b[0] == number and b[1] in by_col:
                    values[b[4]] = by_col[b[1]]
                if b[0] <= number <= b[2] and b[4] in values:
                    by_col |= {col: values[b[4]]._replace(row=number, col=col, merge=b[4]) for col in range(b[1], b[3] + 1)}
            return number, [by_col[c] for c in sorted(by_col) if columns is None or c in columns]

        waiting = sorted({r for b in boxes for r in range(b[0], b[2] + 1) if last is None or r <= last})
        for number, row in self._stored(sheet, 1, last, None):
            while waiting and waiting[0] <= number:
                missing = waiting.pop(0)
                if missing < number and missing >= first:
                    yield filled(missing, [])
            got = filled(number, row)
            if number >= first:
                yield got
        for missing in waiting:
            if missing >= first:
                yield filled(missing, [])

    def _stored(self, sheet: str, first: int, last: int | None, columns: set[int] | None) -> Iterator[tuple[int, list[Cell]]]:
        kinds, number = self.kinds(), 0
        for row in elements(self.zip, self.sheets[sheet], {"row"}):
            number = int(row.get("r", number + 1))
            if last is not None and number > last:
                return
            if number < first:
                continue
            at, cells = 0, []
            for c in row:
                m = re.match("[A-Z]+", c.get("r", ""))
                at = column_number(m[0]) if m else at + 1
                if columns is None or at in columns:
                    cells.append(self._cell(c, number, at, kinds))
            yield number, cells

    def _cell(self, c: ET.Element, row: int, col: int, kinds: list[str]) -> Cell:
        stored, text, formula, num, moment = c.get("t", "n"), None, None, None, None
        for k in c:
            name = tag(k)
            if name == "v":
                text = k.text
            elif name == "f":
                formula = k.text or ""
            elif name == "is":
                text = string_item(k)
        if stored == "s" and text is not None:
            kind, text = "string", self.shared()[int(text)]
        elif stored in ("inlineStr", "str"):
            kind, text = "string", unescaped(text or "") if stored == "str" else text or ""
        elif stored == "b":
            kind, text = "boolean", "TRUE" if text == "1" else "FALSE"
        elif stored == "e":
            kind = "error"
        elif stored == "d" and text:
            kind, moment = "date", dt.datetime.fromisoformat(text.rstrip("Z"))
        elif text is None:
            kind = "blank"
        else:
            style = int(c.get("s", 0))
            kind, num = kinds[style] if style < len(kinds) else "number", float(text)
            if kind == "date":
                moment = from_serial(num, self.date1904)
                kind = kind if moment else "number"
        if moment is not None:
            text = moment.date().isoformat() if moment.time() == dt.time() else moment.isoformat(sep=" ")
        return Cell(row, col, kind, num, text, formula, moment, None)


def cell_xml(v, place: str) -> str:
    """A value as a stored cell; nothing for None."""
    if v is None:
        return ""
    if isinstance(v, bool):
        return f'<c r="{place}" t="b"><v>{int(v)}</v></c>'
    if isinstance(v, (dt.datetime, dt.date)):
        n = to_serial(v.replace(tzinfo=None) if isinstance(v, dt.datetime) else v)
        if n is not None:
            return f'<c r="{place}" s="{2 if isinstance(v, dt.datetime) else 1}"><v>{n!r}</v></c>'
        v = v.isoformat()
    if isinstance(v, float) and (v != v or v in (float("inf"), float("-inf"))):
        return f'<c r="{place}" t="e"><v>#NUM!</v></c>'
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        return f'<c r="{place}"><v>{v}</v></c>'
    return f'<c r="{place}" t="inlineStr"><is><t xml:space="preserve">{escaped(str(v))}</t></is></c>'


def formula_xml(text: str, place: str) -> str:
    return f'<c r="{place}"><f>{escaped(text[1:])}</f></c>'


_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_SHEET = "application/vnd.openxmlformats-officedocument.spreadsheetml"


def write_package(file, columns: list[str] | None, rows: Iterable[Iterable], sheet: str = "Sheet1", most_rows: int = 1_048_576, formulas: bool = False, names: dict[str, str] | None = None, merges: list[str] | None = None) -> int:
    """Stream rows into a workbook, opening a further sheet after ``most_rows`` rows; the number of data rows.

    The file needs no seeking. With ``formulas`` texts that begin with = are formulas.
    """
    letters, titles, written = [column_letters(i + 1) for i in range(len(columns or []))], [], 0
    rows = iter(rows)
    waiting = next(rows, None)
    with zipfile.ZipFile(file, "w", zipfile.ZIP_DEFLATED) as z:
        while waiting is not None or not titles:
            titles.append(sheet if not titles else f"{sheet[:25]} {len(titles) + 1}")
            with z.open(f"xl/worksheets/sheet{len(titles)}.xml", "w", force_zip64=True) as out:
                out.write(f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="{_MAIN}"><sheetData>'.encode())
                r = 0
                if columns:
                    r = 1
                    out.write(f'<row r="1">{"".join(cell_xml(c, f"{a}1") for c, a in zip(columns, letters))}</row>'.encode())
                while waiting is not None and r < most_rows:
                    r += 1
                    values = list(waiting)
                    if len(values) > len(letters):
                        letters = [column_letters(i + 1) for i in range(len(values))]
                    body = "".join(formula_xml(v, f"{a}{r}") if formulas and isinstance(v, str) and v[:1] == "=" else cell_xml(v, f"{a}{r}") for v, a in zip(values, letters))
                    out.write(f'<row r="{r}">{body}</row>'.encode("utf-8", "surrogatepass"))
                    written += 1
                    waiting = next(rows, None)
                merged = f'<mergeCells count="{len(merges)}">{"".join(f"<mergeCell ref={chr(34)}{m}{chr(34)}/>" for m in merges)}</mergeCells>' if merges and len(titles) == 1 else ""
                out.write(f"</sheetData>{merged}</worksheet>".encode())
        number = range(1, len(titles) + 1)
        overrides = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{_SHEET}.worksheet+xml"/>' for i in number)
        defined = "".join(f'<definedName name="{escape(n, {chr(34): "&quot;"})}">{escape(v)}</definedName>' for n, v in (names or {}).items())
        sheets = "".join(f'<sheet name="{escape(t, {chr(34): "&quot;"})}" sheetId="{i}" r:id="r{i}"/>' for i, t in zip(number, titles))
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{_MAIN}" xmlns:r="{_OFFICE}"><sheets>{sheets}</sheets>' + (f"<definedNames>{defined}</definedNames>" if defined else "") + "</workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{_PACKAGE}/relationships">' + "".join(f'<Relationship Id="r{i}" Type="{_OFFICE}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in number) + f'<Relationship Id="s" Type="{_OFFICE}/styles" Target="styles.xml"/></Relationships>')
        z.writestr("xl/styles.xml", f'<styleSheet xmlns="{_MAIN}"><fonts count="1"><font/></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="3"><xf numFmtId="0"/><xf numFmtId="14" applyNumberFormat="1"/><xf numFmtId="22" applyNumberFormat="1"/></cellXfs></styleSheet>')
        z.writestr("_rels/.rels", f'<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="r1" Type="{_OFFICE}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("[Content_Types].xml", f'<Types xmlns="{_PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{_SHEET}.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="{_SHEET}.styles+xml"/>{overrides}</Types>')
    return written
