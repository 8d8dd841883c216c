import datetime as dt
import io
import zipfile
from decimal import Decimal
from xml.etree import ElementTree as ET

import pytest
from data import BASE, rows, sales

from vendaflow.__main__ import main
from vendaflow.errors import LoadError, SourceError
from vendaflow.operators.staging import stage
from vendaflow.plans.warehouse import Warehouse
from vendaflow.schema import CANONICAL, HEADERS
from vendaflow.sources.files import find_source, read_csv, read_source
from vendaflow.sources import xlsx
from vendaflow.sources.jdbc import postgres_options
from vendaflow.sources.workbooks import SHEET, pack_workbooks, workbook
from vendaflow.sources.xlsx import read_xlsx


def write_csv(path, header, *lines, bom=False, quote=False):
    form = '"{}"' if quote else "{}"
    text = [",".join(header)] + [",".join(form.format(v) for v in line) for line in lines]
    path.write_text(("﻿" if bom else "") + "\n".join(text) + "\n", encoding="utf-8")
    return str(path)


ENGLISH = [pair[0] for pair in HEADERS.values()]
PORTUGUESE = [pair[1] for pair in HEADERS.values()]
VALUES = [BASE[c] for c in CANONICAL]


def test_five_kinds_of_file_read_the_same(spark, tmp_path):
    turned = list(range(20, -1, -1))
    files = [
        write_csv(tmp_path / "en.csv", ENGLISH, VALUES),
        write_csv(tmp_path / "pt.csv", PORTUGUESE, VALUES),
        write_csv(tmp_path / "bom.csv", [f" {h} " for h in ENGLISH], VALUES, bom=True),
        write_csv(tmp_path / "order.csv", [ENGLISH[i] for i in turned], [VALUES[i] for i in turned]),
        write_csv(tmp_path / "extra.csv", ["note", *ENGLISH], ["x", *VALUES]),
    ]
    for file in files:
        assert read_csv(spark, file).select(*CANONICAL).collect() == sales(spark, {}).collect()
    together = read_csv(spark, *files)
    assert together.count() == 5 and together.distinct().count() == 1


def test_folder_with_two_headers(spark, tmp_path):
    write_csv(tmp_path / "a.csv", ENGLISH, VALUES)
    write_csv(tmp_path / "b.csv", PORTUGUESE[::-1], VALUES[::-1])
    (tmp_path / "c.csv").write_text("")
    together = read_csv(spark, str(tmp_path))
    assert together.count() == 2 and together.distinct().count() == 1
    with pytest.raises(SourceError, match="no file"):
        read_csv(spark, str(tmp_path / "none*.csv"))


def test_lines_with_a_wrong_number_of_fields(spark, tmp_path):
    extra = [*VALUES[:17], "1", *VALUES[17:]]
    file = write_csv(tmp_path / "m.csv", ["note", *ENGLISH], ["x", *VALUES], ["x", *extra], ["x", *VALUES[:-1]])
    staged = stage(read_csv(spark, file))
    assert sorted(str(r.problems) for r in staged.select("problems").collect()) == ["None", "line", "line"]
    house = Warehouse(spark, str(tmp_path / "house"))
    with pytest.raises(LoadError, match="2 unfit rows.*line"):
        house.load(read_csv(spark, file))
    assert house.load(read_csv(spark, file), strict=False).loaded == 1


def test_quotes_commas_and_line_breaks(spark, tmp_path):
    values = list(VALUES)
    values[CANONICAL.index("product_name")] = 'Saw, 5"" blade'
    file = write_csv(tmp_path / "q.csv", ENGLISH, values, quote=True)
    assert read_csv(spark, file).first().product_name == 'Saw, 5" blade'
    values[CANONICAL.index("product_name")] = "two\nlines"
    file = write_csv(tmp_path / "m.csv", ENGLISH, values, quote=True)
    assert read_csv(spark, file, multiline=True).first().product_name == "two\nlines"


def test_leading_zeros_stay(spark, tmp_path):
    values = ["01234" if c == "postal_code" else BASE[c] for c in CANONICAL]
    file = write_csv(tmp_path / "z.csv", ENGLISH, values)
    assert stage(read_csv(spark, file)).first().postal_code == "01234"


def test_missing_column_in_a_file(spark, tmp_path):
    file = write_csv(tmp_path / "x.csv", ENGLISH[:-1], VALUES[:-1])
    with pytest.raises(SourceError, match="profit"):
        read_csv(spark, file)


def cells(**changes):
    typed = {
        "row_id": 1, "order_date": dt.date(2017, 1, 1), "ship_date": dt.date(2016, 2, 29),
        "sales": Decimal("957.5775"), "quantity": 2, "discount": Decimal("0.2"),
        "profit": Decimal("-3.5"), "postal_code": 10024,
    }
    return [{**BASE, **typed, **changes}[c] for c in CANONICAL]


def test_xlsx(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(workbook(ENGLISH, [
        cells(), cells(row_id=2, product_name="A & <B>", postal_code=None, ship_mode="Ação"),
    ]))
    (tmp_path / "b.xlsx").write_bytes(workbook(PORTUGUESE[::-1], [cells(row_id=3)[::-1]]))
    staged = stage(read_xlsx(spark, str(tmp_path)))
    d = Decimal
    names = ["row_id", "ship_date", "ship_mode", "postal_code", "product_name", "sales", "discount"]
    day = dt.date(2016, 2, 29)
    assert rows(staged, *names) == {
        (1, day, "First Class", "10024", "Saw", d("957.5775"), d("0.2")),
        (2, day, "Ação", None, "A & <B>", d("957.5775"), d("0.2")),
        (3, day, "First Class", "10024", "Saw", d("957.5775"), d("0.2")),
    }
    assert staged.filter("problems is not null").isEmpty()


def test_xlsx_without_discount_or_profit(spark, tmp_path):
    keep = [i for i, c in enumerate(CANONICAL) if c != "discount"]
    content = workbook([ENGLISH[i] for i in keep], [[cells()[i] for i in keep]])
    (tmp_path / "a.xlsx").write_bytes(content)
    assert read_xlsx(spark, str(tmp_path / "a.xlsx")).first().discount == "0"
    (tmp_path / "b.xlsx").write_bytes(workbook(ENGLISH[:-1], [cells()[:-1]]))
    with pytest.raises(Exception, match="b.xlsx: columns missing in the source: profit"):
        read_xlsx(spark, str(tmp_path / "b.xlsx")).collect()


def test_first_name_that_exists(spark, tmp_path):
    names = ["sales.xlsx", "sales.csv", "other.csv"]
    with pytest.raises(SourceError, match="none of sales.xlsx"):
        find_source(spark, str(tmp_path), names)
    for name in reversed(names):
        (tmp_path / name).write_text("x")
        assert find_source(spark, str(tmp_path), names).endswith(name)


def test_source_by_file_type(spark, tmp_path):
    file = write_csv(tmp_path / "en.csv", ENGLISH, VALUES)
    assert read_source(spark, file).count() == 1
    sales(spark, {}).write.parquet(str(tmp_path / "x.parquet"))
    assert read_source(spark, str(tmp_path / "x.parquet")).count() == 1
    with pytest.raises(SourceError, match="legacy"):
        read_source(spark, "old.xls")


def test_database_options():
    options = postgres_options("db", 5432, "dw", "u", "p")
    assert options["url"] == "jdbc:postgresql://db:5432/dw"


def test_command_line(spark, tmp_path, capsys):
    write_csv(tmp_path / "sales.csv", ENGLISH, VALUES)
    root = str(tmp_path / "house")
    report = ["report", "--root", root, "kpi_formatted"]
    assert main(report) == 1
    assert "empty" in capsys.readouterr().err
    load = ["load", "--root", root, "--folder", str(tmp_path), "--names", "no.csv", "sales.csv"]
    assert main(load) == 0
    assert "loaded: 1" in capsys.readouterr().out
    assert main([*report, "--anos", "2017"]) == 0
    assert "$200.00" in capsys.readouterr().out
    assert main(["report", "--root", root, "produtos", "--out", str(tmp_path / "out")]) == 0
    assert spark.read.csv(str(tmp_path / "out"), header=True).first().nome_produto == "Saw"
    assert main(["load", "--root", root, "--folder", str(tmp_path), "--names", "no.csv"]) == 1
    assert "none of no.csv" in capsys.readouterr().err


def test_reports_are_written_and_printed_whole(spark, tmp_path, capsys):
    lines = [[str(i) if c == "row_id" else f"N{i}" if c == "product_name" else f"P{i}" if c == "product_id"
              else BASE[c] for c in CANONICAL] for i in range(1, 1202)]
    write_csv(tmp_path / "sales.csv", ENGLISH, *lines)
    root, out = str(tmp_path / "house"), str(tmp_path / "out")
    assert main(["load", "--root", root, "--folder", str(tmp_path), "--names", "sales.csv"]) == 0
    assert main(["report", "--root", root, "produtos", "--out", out]) == 0
    assert spark.read.csv(out, header=True).count() == 1201
    capsys.readouterr()
    assert main(["report", "--root", root, "produtos"]) == 0
    assert len(capsys.readouterr().out.splitlines()) == 1202


MAIN = f'xmlns="{SHEET}"'
SHEETS = {
    "placed": f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n<worksheet {MAIN} xmlns:x="y"><cols><col min="1"/></cols>'
    '<sheetData><row r="1" spans="1:3" x:d="0.2"><c r="A1" s="1" t="s"><v>1</v></c><c r="AB1"><v>2.50</v></c></row>'
    '<row r="3"/><row r="4"><c r="C4" s="1"><v>42736</v></c><c t="n"><v>7</v></c><c r="E4" t="e"><v>#N/A</v></c></row></sheetData></worksheet>',
    "odd cells": f'<worksheet {MAIN}><sheetData>\n <row>\n <c t="s" s="0"><v>0</v></c> <c><f>1+1</f><v>2</v></c> </row>\n'
    '<row><c t="inlineStr"><is><t>a&amp;b</t></is></c><c t="str"><v>x &lt; y</v></c><c t="str"><v>é&#10;</v></c></row>'
    '<row></row><row/><row r="9"><c/><c t="b"><v>1</v></c><c t="str"><v>]]</v></c><c t="str"><v></v></c></row></sheetData></worksheet>',
    "comment": f'<worksheet {MAIN}><sheetData><row><c><v>1</v></c></row><!-- <row><c><v>8</v></c></row> --><row><c><v>2</v></c></row></sheetData></worksheet>',
    "literal": f'<worksheet {MAIN}><sheetData><row><c><v>1</v></c></row><row><c t="str"><v><![CDATA[</row>]]></v></c></row></sheetData></worksheet>',
    "prefix": f'<m:worksheet xmlns:m="{SHEET}"><m:sheetData><m:row><m:c><m:v>3</m:v></m:c></m:row></m:sheetData></m:worksheet>',
    "foreign": f'<worksheet {MAIN}><sheetData><row><c><v>1</v></c></row><row xmlns="z"><c><v>2</v></c></row></sheetData></worksheet>',
    "empty": f'<worksheet {MAIN}><sheetData/></worksheet>',
    "latin": f'<?xml version="1.0" encoding="ISO-8859-1"?><worksheet {MAIN}><sheetData><row><c t="str"><v>Ação</v></c></row></sheetData></worksheet>',
}


@pytest.mark.parametrize("size", [7, 100, 1 << 20])
@pytest.mark.parametrize("name", SHEETS)
def test_cut_rows_are_the_parser_s(monkeypatch, name, size):
    monkeypatch.setattr(xlsx, "READ_BYTES", size)
    monkeypatch.setattr(xlsx, "KNOWN_CELLS", 2)
    content = SHEETS[name].encode("latin-1" if name == "latin" else "utf-8")
    rest = (["zero", "one"], {1}, xlsx.EPOCH_1900)
    expected = list(xlsx._parsed_rows(io.BytesIO(content), *rest))
    assert list(xlsx._rows(lambda: io.BytesIO(content), *rest)) == expected
    assert name == "empty" or any(expected)
    with pytest.raises(ET.ParseError):
        list(xlsx._rows(lambda: io.BytesIO(content[:-20]), *rest))


def test_plain_workbooks_are_cut_at_their_tags(spark, tmp_path, monkeypatch):
    for name in ("_parsed_rows", "_row"):
        monkeypatch.setattr(xlsx, name, lambda *_: pytest.fail("the XML parser was asked"))
    content = workbook(ENGLISH, [cells(row_id=i, product_name="a\tb", postal_code=None) for i in range(25_000)])
    batches = list(xlsx._workbook("a.xlsx", content))
    assert [b.num_rows for b in batches] == [10_000, 10_000, 5_000]
    assert batches[2].to_pylist()[-1] == {
        **BASE, "row_id": "24999", "product_name": "a\tb", "postal_code": None, "order_date": "2017-01-01 00:00:00",
        "ship_date": "2016-02-29 00:00:00", "sales": "957.5775", "discount": "0.2", "profit": "-3.5",
    }


def test_shared_texts():
    items = '<si><t>a</t></si><si><t xml:space="preserve"> b\n</t></si><si><r><t>c</t></r><r><t>&lt;d</t></r><rPh><t>x</t></rPh></si><si><t/></si>'
    for text in (f"<sst {MAIN}>{items}</sst>", f"<sst {MAIN}>{items}<!-- --></sst>", f"\n<sst count='4' {MAIN}>\n{items}\n</sst>\n"):
        with zipfile.ZipFile(io.BytesIO(), "w") as book:
            book.writestr("xl/sharedStrings.xml", text)
            assert xlsx._shared_texts(book) == ["a", " b\n", "c<d", ""]


def test_packed_rows_come_back(spark):
    values = [
        (1, "a & <b>", dt.date(1996, 2, 29), Decimal("-3.5000"), None), (2, None, None, None, 7),
        (-3, " a", dt.date(1899, 12, 31), Decimal("0.0001"), 0),
    ]
    names = ["Row ID", "Order ID", "Order Date", "Sales", "Quantity"]
    others = [n for n in ENGLISH if n not in names]
    df = spark.createDataFrame(values, "`Row ID` long, `Order ID` string, `Order Date` date, Sales decimal(12,4), Quantity int")
    df = df.selectExpr("*", *[f"'x' AS `{n}`" for n in others])
    found = xlsx.parse_workbooks(pack_workbooks(df)).select("row_id", "order_id", "order_date", "sales", "quantity", "city")
    assert set(map(tuple, found.collect())) == {
        ("1", "a & <b>", "1996-02-29 00:00:00", "-3.5", None, "x"), ("2", None, None, None, "7", "x"),
        ("-3", " a", "1899-12-31 00:00:00", "0.0001", "0", "x"),
    }
