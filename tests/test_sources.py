"""Workbooks as a data source, and nodes of documents by their intervals."""

import datetime as dt
import decimal
import io
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from gridloom.sources import documents, workbook
from gridloom.sources.ooxml import Workbook, escaped, format_kind, from_serial, to_serial, unescaped, write_package


@pytest.fixture(scope="module")
def source(spark):
    workbook.register(spark)
    return spark


def package(rows, **options):
    out = io.BytesIO()
    write_package(out, options.pop("columns", None), rows, **options)
    return out


def test_serials_and_formats():
    for day, n in ((dt.date(1900, 1, 1), 1), (dt.date(1900, 2, 28), 59), (dt.date(1900, 3, 1), 61), (dt.date(2024, 2, 29), 45351)):
        assert to_serial(day) == n and from_serial(n).date() == day
    assert from_serial(60).date() == dt.date(1900, 2, 28) and from_serial(0, True).date() == dt.date(1904, 1, 1)
    assert from_serial(45351.75) == dt.datetime(2024, 2, 29, 18) and from_serial(1e9) is None and to_serial(dt.date(1899, 12, 31)) is None
    kinds = {"yyyy-mm-dd": "date", "m/d/yy h:mm": "date", "h:mm:ss.00": "time", "[h]:mm": "time", "0.00": "number", '"day" 0': "number", "Y0.00": "number", "General": "number", "mmm": "date", "[Red]#,##0": "number", "@": "number"}
    assert {k: format_kind(k) for k in kinds} == kinds
    for text in ("a\r\nb", "\x00\x1f", "_x0041_", "<&>", "plain", "￿"):
        assert unescaped(escaped(text).replace("&lt;", "<").replace("&gt;", ">").replace("&amp;", "&")) == text


def test_tables_go_out_and_come_back(source, tmp_path):
    rows = [(i, i * 1.5, f"name <{i}> & \x01\r\n", i % 2 == 0, dt.date(1999, 12, 31) + dt.timedelta(days=i), dt.datetime(2024, 1, 1, 5, 6, 7) + dt.timedelta(hours=i), decimal.Decimal(i) / 4, 2**60 + i) for i in range(500)]
    rows += [(None,) * 8, (501, float("nan"), "", False, dt.date(1850, 1, 1), None, None, -1)]
    schema = "i int, x double, s string, b boolean, d date, t timestamp_ntz, m decimal(9,2), big bigint"
    df = source.createDataFrame(rows, schema)
    where = str(tmp_path / "books")
    df.repartition(50).write.format("workbook").mode("overwrite").save(where)
    assert len([f for f in os.listdir(where) if f.startswith("part-")]) == 50 and not [f for f in os.listdir(where) if f.startswith("_")]
    reload = lambda: source.read.format("workbook").schema(schema).option("header", True).load(where)
    back = reload()
    assert back.rdd.getNumPartitions() == 50
    want = [tuple(None if isinstance(v, float) and v != v else v for v in r) for r in rows]
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(want, key=repr)
    few = source.read.format("workbook").schema("D date, missing string").option("header", True).load(where + "/part-000*.xlsx")
    assert sorted((r.D for r in few.collect()), key=repr) == sorted((r[4] for r in want), key=repr)
    texts = source.read.format("workbook").option("header", True).load(where)
    assert texts.columns == df.columns and texts.where("i = '7'").first().d == "2000-01-07"
    df.limit(3).coalesce(1).write.format("workbook").mode("append").save(where)
    assert reload().count() == len(rows) + 3
    df.limit(3).coalesce(1).write.format("workbook").mode("overwrite").save(where)
    assert reload().count() == 3


def test_a_failed_write_leaves_nothing(source, tmp_path):
    where = str(tmp_path / "failed")
    bad = source.range(40, numPartitions=4).select(F.when(F.col("id") == 35, F.raise_error(F.lit("no")).cast("string")).otherwise("x").alias("s"))
    with pytest.raises(Exception, match="no"):
        bad.write.format("workbook").mode("overwrite").save(where)
    assert os.listdir(where) == []
    with pytest.raises(Exception, match="types"):
        source.sql("SELECT array(1) AS a").write.format("workbook").mode("overwrite").save(where)


def test_filters_choose_sheets_and_rows(source, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.xlsx").write_bytes(package([(i, f"{name}{i}") for i in range(25)], columns=["n", "s"], most_rows=11).getvalue())
    (tmp_path / "~$a.xlsx").write_bytes(b"lock")
    cells = source.read.format("workbook").load(str(tmp_path))
    assert cells.rdd.getNumPartitions() == 6 and cells.count() == 2 * (3 * 2 + 25 * 2)
    one = cells.where("sheet = 'Sheet1 2' AND row > 3 AND row <= 5 AND col = 2 AND num IS NULL")
    assert one.rdd.getNumPartitions() == 2 and sorted(r.text for r in one.collect()) == ["a12", "a13", "b12", "b13"]
    assert cells.where(F.col("file").endswith("b.xlsx") & (F.col("sheet") == "nope")).count() == 0
    assert source.read.format("workbook").option("sheet", "Sheet1 3").option("header", True).load(str(tmp_path)).count() == 10
    (tmp_path / "c.xlsx").write_bytes(b"not a zip")
    with pytest.raises(Exception, match="zip"):
        source.read.format("workbook").load(str(tmp_path)).count()
    with pytest.raises(Exception, match="nowhere"):
        source.read.format("workbook").load("/nowhere/at/all").count()


def test_merged_cells_formats_and_shared_texts(source, tmp_path):
    out = package([("top", None, 3), (None, None, 4), ("=A1&B1", None, None)], formulas=True, merges=["A1:B2"], names={"Total": "Sheet1!$C$1"})
    data = zipfile.ZipFile(out)
    parts = {n: data.read(n) for n in data.namelist()}
    parts["xl/sharedStrings.xml"] = b'<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><si><r><t>sha</t></r><r><t>red</t></r><rPh><t>no</t></rPh></si></sst>'
    parts["xl/styles.xml"] = parts["xl/styles.xml"].replace(b"<fonts", b'<numFmts><numFmt numFmtId="164" formatCode="yyyy&quot;y&quot;"/></numFmts><fonts').replace(b'numFmtId="22"', b'numFmtId="164"')
    sheet = parts["xl/worksheets/sheet1.xml"]
    parts["xl/worksheets/sheet1.xml"] = sheet.replace(b"</sheetData>", b'<row><c t="s"><v>0</v></c><c s="2"><v>45351</v></c><c t="e"><v>#REF!</v></c><c t="str"><f>X</f><v>f</v></c><c t="d"><v>2024-02-29T12:00:00Z</v></c></row></sheetData>')
    with zipfile.ZipFile(tmp_path / "m.xlsx", "w") as z:
        for n, content in parts.items():
            z.writestr(n, content)
    read = source.read.format("workbook").option("merged", True)
    got = {(c.row, c.col): c for c in read.load(str(tmp_path)).collect()}
    assert got[(1, 1)].merge == "A1:B2" and (1, 2) not in got and got[(1, 3)].merge is None and got[(3, 1)].formula == "A1&B1"
    assert [(got[(4, i)].kind, got[(4, i)].text) for i in range(1, 6)] == [("string", "shared"), ("date", "2024-02-29"), ("error", "#REF!"), ("string", "f"), ("date", "2024-02-29 12:00:00")]
    full = {(c.row, c.col): c.text for c in read.option("fillMerged", True).load(str(tmp_path)).where("row <= 2").collect()}
    assert full == {(1, 1): "top", (1, 2): "top", (2, 1): "top", (2, 2): "top", (1, 3): "3", (2, 3): "4"}
    second = {(c.row, c.col): c.text for c in read.option("fillMerged", True).load(str(tmp_path)).where("row = 2").collect()}
    assert second == {(2, 1): "top", (2, 2): "top", (2, 3): "4"}
    assert Workbook(str(tmp_path / "m.xlsx")).names == [("Total", "Sheet1!$C$1")]
    spark_side = workbook.read_workbooks(source, str(tmp_path / "*.xlsx"))
    assert sorted((c.row, c.col, c.kind, c.text) for c in spark_side.collect()) == sorted((c.row, c.col, c.kind, c.text) for c in got.values())


def test_a_sheet_is_pulled_not_loaded():
    out = package(((i, "x" * 200) for i in range(60_000)), columns=["n", "s"])
    book = Workbook(out)
    import tracemalloc

    tracemalloc.start()
    assert sum(1 for _ in book.cells("Sheet1")) == 120_002
    assert tracemalloc.get_traced_memory()[1] < 4 << 20
    tracemalloc.stop()
    assert [c.row for c in book.cells("Sheet1", 59_999, 60_000, {1})] == [59_999, 60_000]


def document(body):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="w"><w:body>{body}</w:body></w:document>')
        z.writestr("word/header1.xml", '<w:hdr xmlns:w="w"><w:p><w:r><w:t>head</w:t></w:r></w:p></w:hdr>')
    return out.getvalue()


def test_nodes_know_their_interval(spark, tmp_path):
    body = '<w:p><w:pPr><w:pStyle w:val="H1"/></w:pPr><w:r><w:rPr><w:b/></w:rPr><w:t>one</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>x</w:t></w:r></w:p></w:tc><w:tc/></w:tr></w:tbl>'
    (tmp_path / "a.docx").write_bytes(document(body))
    rows = documents.read_documents(spark, str(tmp_path / "*.docx")).collect()
    by = {(r.part, r.path): r for r in rows}
    main = "word/document.xml"
    assert by[(main, "/body/paragraph[1]")].style == "H1" and by[(main, "/body/paragraph[1]/run[1]")].format == {"b": "true"}
    assert by[("word/header1.xml", "/header1/paragraph[1]")].text == "head" and by[(main, "/body/table[1]")].text == "x"
    for r in rows:  # ancestors by path are those by interval
        inside = {x.path for x in rows if x.part == r.part and r.pre < x.pre <= r.post}
        assert inside == {x.path for x in rows if x.part == r.part and x.path.startswith(r.path + "/")}
        assert r.depth == r.path.count("/") - 1


def test_charsets(spark, tmp_path):
    from gridloom.sources.charset import decode, decoded, read_text_tables

    table = 'name,word\n"Zoë, é",“x”\nÑ,”\n'
    plain = table.replace("“", "'").replace("”", "'")
    files = {"utf8": plain.encode(), "mark": b"\xef\xbb\xbf" + plain.encode(), "le": b"\xff\xfe" + plain.encode("utf-16-le"), "be": b"\xfe\xff" + plain.encode("utf-16-be")}
    for name, data in files.items():
        (tmp_path / f"{name}.csv").write_bytes(data)
    got = read_text_tables(spark, str(tmp_path / "*.csv"))
    assert got.columns == ["file", "name", "word"] and got.count() == 8
    assert {(r.name, r.word) for r in got.collect()} == {("Zoë, é", "'x'"), ("Ñ", "'")}
    for name, data in (("latin", plain.encode("latin-1")), ("windows", table.encode("cp1252"))):
        where = tmp_path / name
        where.mkdir()
        (where / "t.csv").write_bytes(data)
        want = {("Zoë, é", "“x”"), ("Ñ", "”")} if name == "windows" else {("Zoë, é", "'x'"), ("Ñ", "'")}
        assert {(r.name, r.word) for r in read_text_tables(spark, str(where), declared={"latin": "ISO-8859-1", "windows": "ansi"}[name]).collect()} == want
    assert decode(b"<meta charset='windows-1252'>\x80\x81") == "<meta charset='windows-1252'>€\x81" and decode(b"\xe9", "ascii") == "?"
    assert decode(b"\xff\xfe\x41\x00\x42") == "A�" and decode(b"\xe9") == "�" and decode(b"", "nonsense") == "" and decode(None) is None
    df = spark.createDataFrame([(bytearray(b"\x93"), "text/html; charset=cp1252"), (bytearray(b"\x93"), "latin1"), (bytearray("é".encode()), "text/html"), (None, None)], "b binary, t string")
    assert [r[0] for r in df.select(decoded(F.col("b"), F.col("t"))).collect()] == ["“", "\x93", "é", None]


def test_grids_in_text_and_json_lines(spark):
    from gridloom.sources.charset import grid_rows, json_lines

    texts = ["a, b ;1,2", ' "x;y" , "say ""hi""" ;;, ;,z', "﻿one", "", None, '"open, end', "a;", '"q"t,"  kept "']
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    got = {}
    for r in grid_rows(df, "t", ["id"]).orderBy("id", "row").collect():
        got.setdefault(r.id, []).append(r.cells)
    assert got == {0: [["a", "b"], ["1", "2"]], 1: [["x;y ", 'say "hi" '], ["", "z"]], 2: [["one"]], 5: [["open, end"]], 6: [["a"]], 7: [["qt", "  kept "]]}
    lines = grid_rows(spark.createDataFrame([(1, 'a\tb\r\n"c\nd"\te\r\n')], "id int, t string"), "t", ["id"], "\t", "\n")
    assert [r.cells for r in lines.orderBy("row").collect()] == [["a", "b"], ["c\nd", "e"]]
    out = json_lines(spark.createDataFrame([(1, "x", ["w"]), (2, None, [])], "i int, s string, w array<string>").select("i", "s", "w"), F.col("w"))
    assert [r.value for r in out.collect()] == ['{"success":true,"data":{"i":1,"s":"x","w":["w"]},"warnings":["w"]}', '{"success":true,"data":{"i":2,"w":[]}}']
