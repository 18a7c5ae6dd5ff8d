"""Workbooks as tables, and tables as workbooks."""

import datetime as dt
import math
import zipfile
from decimal import Decimal

import pytest

from brevetlake.schemas import schema
from brevetlake.sources import sheets

ROWS = [
    (1, 'a "b" <c> & d', 1.5, True, dt.date(2020, 2, 29), Decimal("12.30"), dt.datetime(2020, 1, 2, 3, 4, 5)),
    (2, "", -0.0, False, dt.date(1900, 3, 1), Decimal("-99999999999999.99"), None),
    (None, None, None, None, None, None, None),
    (9_007_199_254_740_993, "  spaced\tand\r\nbroken \x01 _x0041_ ", 1e300, None, dt.date(1815, 6, 18), None, None),
    (-5, "é漢😀", math.inf, None, dt.date(9999, 12, 31), Decimal("0.01"), None),
]
COLUMNS = "id long, text string, amount double, flag boolean, day date, price decimal(18,2), at timestamp"


@pytest.mark.parametrize("rows", [1, 2, 1000])
def test_what_is_written_is_read(spark, tmp_path, rows):
    df = spark.createDataFrame(ROWS, COLUMNS)
    sheets.write_sheets(df.coalesce(1), f"file://{tmp_path}/book", rows=rows)
    assert len(list((tmp_path / "book").iterdir())) == -(-len(ROWS) // rows)
    read = sheets.read_sheets(spark, f"file://{tmp_path}/book", df.schema)
    assert sorted(map(tuple, read.collect()), key=str) == sorted(ROWS, key=str)
    assert read.dtypes == df.dtypes


def test_tables_without_rows_and_rewritten_folders(spark, tmp_path):
    df = spark.createDataFrame(ROWS, COLUMNS)
    path = f"file://{tmp_path}/book"
    sheets.write_sheets(df, path)
    sheets.write_sheets(df.limit(0), path)
    assert [p.suffix for p in (tmp_path / "book").iterdir()] == [".xlsx"]
    assert sheets.read_sheets(spark, path, df.schema).collect() == []


def test_a_failed_write_leaves_the_old_workbooks(spark, tmp_path):
    path = f"file://{tmp_path}/book"
    sheets.write_sheets(spark.createDataFrame([("old",)], "text string"), path)
    long = spark.createDataFrame([("new",), ("x" * 40_000,)], "text string")
    with pytest.raises(Exception, match="a value of text has 40000 characters"):
        sheets.write_sheets(long, path)
    assert [r.text for r in sheets.read_sheets(spark, path, long.schema).collect()] == ["old"]
    assert len(list((tmp_path / "book").iterdir())) == 1
    with pytest.raises(ValueError, match="nested"):
        sheets.write_sheets(spark.createDataFrame([([1],)], "a array<int>"), path)


def book(path, cells, shared="", properties=""):
    """A workbook as other programs write them: shared texts, no references, gaps, formulas, and a second sheet."""
    parts = sheets._fixed_parts("x")
    parts["xl/workbook.xml"] = parts["xl/workbook.xml"].replace("<sheets>", f"{properties}<sheets>").replace("</sheets>", '<sheet name="rules" sheetId="2" r:id="rId9"/></sheets>')
    parts["xl/_rels/workbook.xml.rels"] = parts["xl/_rels/workbook.xml.rels"].replace("</Relationships>", '<Relationship Id="rId9" Type="t" Target="/xl/worksheets/sheet2.xml"/></Relationships>')
    parts["xl/worksheets/sheet1.xml"] = f'<worksheet xmlns="{sheets.MAIN}"><sheetData/></worksheet>'
    parts["xl/worksheets/sheet2.xml"] = f'<worksheet xmlns="{sheets.MAIN}"><dimension ref="A1"/><sheetData>{cells}</sheetData></worksheet>'
    if shared:
        parts["xl/sharedStrings.xml"] = f'<sst xmlns="{sheets.MAIN}">{shared}</sst>'
    with zipfile.ZipFile(path, "w") as archive:
        for name, text in parts.items():
            archive.writestr(name, text)


def test_workbooks_of_other_programs(spark, tmp_path):
    shared = "<si><t>id</t></si><si><t>text</t></si><si><r><t>ri</t></r><r><t>ch</t></r><rPh><t>reading</t></rPh></si><si><t>day</t></si>"
    cells = (
        '<row r="1"><c t="s"><v>0</v></c><c t="s"><v>1</v></c><c r="AB1" t="s"><v>3</v></c><c t="s"><v>0</v></c></row>'
        '<row r="2"><c r="A2"><v>3.0</v></c><c r="B2" t="s"><v>2</v></c><c r="AB2"><v>2.0</v></c><c><v>77</v></c></row>'
        '<row r="4"><c r="A4"><f>1/0</f><v>12E1</v></c><c r="B4" t="e"><v>#DIV/0!</v></c><c r="AB4" t="str"><f>x</f><v>2020-05-06</v></c></row>'
        '<row><c t="inlineStr"><is><t>no number</t></is></c><c t="b"><v>1</v></c></row>'
    )
    book(tmp_path / "one.xlsx", cells, shared, '<workbookPr date1904="1"/>')
    (tmp_path / "~$one.xlsx").write_text("a lock")
    wanted = schema("text:S id:L day:D")
    read = lambda **more: sheets.read_sheets(spark, f"file://{tmp_path}", wanted, **more).collect()
    assert list(map(tuple, read(sheet="rules"))) == [("rich", 3, dt.date(1904, 1, 3)), (None, None, None), (None, 120, dt.date(2020, 5, 6)), ("true", None, None)]
    assert read() == []
    with pytest.raises(Exception, match="has no sheet 'other'"):
        read(sheet="other")


def test_column_letters():
    for number in [*range(800), 16_383]:
        assert sheets._column(f"{sheets.column_letters(number)}12") == number
    assert [sheets.column_letters(k) for k in (0, 25, 26, 701, 702)] == ["A", "Z", "AA", "ZZ", "AAA"]


def test_rows_are_streamed(tmp_path):
    """What is parsed is forgotten row by row: memory does not follow the number of rows."""
    import tracemalloc

    cells = "".join(f'<row r="{k}"><c r="A{k}" t="inlineStr"><is><t>text {k}</t></is></c></row>' for k in range(1, 60_001))
    book(tmp_path / "long.xlsx", cells)
    tracemalloc.start()
    with zipfile.ZipFile(tmp_path / "long.xlsx") as archive:
        assert sum(1 for _ in sheets.sheet_rows(archive, "rules")) == 60_000
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2_000_000
