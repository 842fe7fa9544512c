"""Workbooks: number formats, date systems, rich texts, cells without reference, rows and files that are refused."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from leadmill.session import scratch_path
from leadmill.sources import xlsx as xl

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


@pytest.mark.parametrize("code, kind", [
    ("General", "number"), ("0.00", "number"), ("#,##0.00_);[Red](#,##0.00)", "number"), ('0" days"', "number"),
    ("[Red]0.0", "number"), ("0\\d", "number"), ("yyyy-mm-dd", "date"), ("[$-409]d/m/yy h:mm AM/PM;@", "date"),
    ("mm:ss.0", "date"), ("[h]:mm:ss", "elapsed"), ("[mm]:ss", "elapsed"), ('"y"0;yyyy', "number")])
def test_format_kind(code, kind):
    assert xl.format_kind(code) == kind


@pytest.mark.parametrize("serial, kind, date1904, text", [
    (45296, "date", False, "2024-01-05 00:00:00"), (45296.5625, "date", False, "2024-01-05 13:30:00"),
    (43834, "date", True, "2024-01-05 00:00:00"), (1, "date", False, "1900-01-01 00:00:00"), (59, "date", False, "1900-02-28 00:00:00"),
    (61, "date", False, "1900-03-01 00:00:00"), (0.5, "date", False, "12:00:00"), (1.25, "elapsed", False, "1 day, 6:00:00"),
    (0.9999999999, "date", True, "1904-01-02 00:00:00"), (1e9, "date", False, None), (float("nan"), "date", False, None)])
def test_serial_text(serial, kind, date1904, text):
    assert xl.serial_text(serial, kind, date1904) == text


def test_cell_text():
    assert [xl.cell_text("", "number", v, False) for v in ("7", "7.0", "1E3", "0.1", "12345678901234567890", "x")] == \
        ["7", "7", "1000", "0.1", "12345678901234567890", "x"]
    assert xl.cell_text("e", "number", "#DIV/0!", False) is None
    assert xl.cell_text("b", "number", "0", False) == "False"
    assert xl.cell_text("d", "number", "2024-01-05T13:30:00Z", False) == "2024-01-05 13:30:00"
    assert xl.cell_text("str", "date", "00123", False) == "00123"


def _book(sheet, shared=None):
    with zipfile.ZipFile(io.BytesIO(xl.workbook_bytes(["a"], []))) as z:
        parts = {n: z.read(n) for n in z.namelist()}
    parts["xl/worksheets/sheet1.xml"] = f"<worksheet {MAIN}><sheetData>{sheet}</sheetData></worksheet>"
    if shared:
        parts["xl/sharedStrings.xml"] = f"<sst {MAIN}>{shared}</sst>"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for n, v in parts.items():
            z.writestr(n, v)
    return out.getvalue()


def test_sheet_rows():
    shared = '<si><t>one</t></si><si><r><t>ri</t></r><r><t>ch</t></r><rPh sb="0" eb="1"><t>hint</t></rPh></si><si/>'
    book = _book('<row><c t="s"><v>0</v></c><c r="D1" t="s"><v>1</v></c><c><v>5</v></c></row><row/>'
                 '<row r="9"><c r="AA9" t="s"><v>2</v></c></row>', shared)
    assert list(xl.sheet_rows(book)) == [["one", None, None, "rich", "5"], [], [None] * 26 + [""]]
    assert list(xl.sheet_rows(_book(""))) == []


def test_slices_refused_rows_and_files(spark):
    root = scratch_path(spark, "books")
    rows = [[str(i), f"v{i}"] for i in range(2 * xl.ROWS_PER_SLICE + 5)]
    books = {"a": xl.workbook_bytes(["K", "V"], rows), "b": b"no zip", "e": _book(""),
             "c": _book('<row><c t="str"><v>K</v></c><c t="str"><v>V</v></c></row><row><c><v>1</v></c></row>'
                        '<row><c><v>2</v></c><c/><c><v>3</v></c></row><row><c><v>4</v></c><c><v>5</v></c><c/></row>'),
             "d": _book('<row><c t="str"><v>K</v></c></row><row><c t="s"><v>7</v></c></row>')}
    for name, data in books.items():
        with xl._open_write(f"{root}/file_id={name}/part.xlsx") as f:
            f.write(data)
    cells = xl.read_rows(spark, root)
    groups = xl.rows_by_header(spark, cells)
    assert len(groups) == 1                                     # d ends in an error, so none of its rows is taken
    got = {(r.file_id, r.k, r.v) for r in groups[0].collect()}
    assert got == {("a", k, v) for k, v in rows} | {("c", "1", None), ("c", "4", "5")}
    bad = xl.refused_rows(cells).select("file_id", "reason", F.col("record")).collect()
    assert sorted((r.file_id, r.reason) for r in bad) == [
        ("b", "file that is no workbook"), ("c", "more cells than the header"), ("d", "file that is no workbook")]
    assert [r.record for r in bad if r.file_id == "c"] == ['["2",null,"3"]']


def test_elements_come_one_at_a_time_and_leave_nothing_behind():
    rows = "".join(f'<row r="{i}"><c><is><r><t>a</t></r><t>{i}</t></is></c><other><c/></other></row>' for i in range(1, 4))
    part = io.BytesIO(f'<worksheet {MAIN}><cols><col/></cols><sheetData>{rows}</sheetData><row r="9"/></worksheet>'.encode())
    seen = [(e.get("r"), len(e)) for e in xl._elements(part, "row")]
    assert seen == [("1", 2), ("2", 2), ("3", 2), ("9", 0)]


def test_column_letters_and_numbers_are_worked_out_once():
    assert [xl._col_letters(i) for i in (0, 25, 26, 701, 702)] == ["A", "Z", "AA", "ZZ", "AAA"]
    assert [xl._col_index(f"{x}7") for x in ("A", "Z", "AA", "ZZ", "AAA")] == [0, 25, 26, 701, 702]
    assert xl._col_letters.cache_info().currsize and xl._column_number.cache_info().currsize


def test_written_workbooks_keep_missing_and_odd_cells(spark):
    path = scratch_path(spark, "odd_books")
    rows = [("id1", "nan", None), ("id1", "", "x<&>"), ("id2", None, " two ")]
    xl.write_workbooks(spark.createDataFrame(rows, "file_id string, a string, b string"), path).count()
    found = xl.read_rows(spark, path).where(F.col("row_no") > 0).collect()
    cells = sorted(((r["path"].split("file_id=")[1][:3], *(r["cells"] + [None] * (2 - len(r["cells"])))) for r in found), key=str)
    assert cells == sorted([("id1", "nan", None), ("id1", "", "x<&>"), ("id2", None, " two ")], key=str)
