"""Quoted CSV read in pieces, against Spark's reading of whole files."""

import csv
import random

import pytest
from samples import sorted_rows

from basketry.sources.quoted_csv import read_quoted_csv
from basketry.sources.sales import _csv_options, read_sales_csv

COLUMNS = ["a", "b", "c"]


@pytest.fixture
def small_pieces(spark):
    """Splits of about a hundred bytes, so records lie over many borders."""
    names = {"spark.sql.files.maxPartitionBytes": "120b", "spark.sql.files.openCostInBytes": "0"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def write(path, records, ends="\n", header="a,b,c"):
    path.write_bytes(ends.join([header, *records, ""]).encode("ISO-8859-1"))
    return str(path)


def some_records(n, seed):
    chance = random.Random(seed)
    pieces = ["x", "Ö", " ", ",", "\n", "\r\n", '""', "long words here", "\n\n", ""]

    def field(at):
        if chance.random() < 0.5:
            return chance.choice(["1", "é", "", "plain text", " padded "]) if at else "k"
        return '"' + "".join(chance.choice(pieces) for _ in range(chance.randint(0, 9))) + '"'

    return [",".join(field(at) for at in range(3)) for _ in range(n)]


def both(spark, path):
    whole = spark.read.options(**_csv_options(True)).csv(path)
    return sorted_rows(read_quoted_csv(spark, path, COLUMNS, "ISO-8859-1")), sorted_rows(whole)


@pytest.mark.parametrize("ends", ["\n", "\r\n"])
def test_pieces_equal_whole_files(spark, tmp_path, small_pieces, ends):
    for seed in range(2):
        write(tmp_path / f"{seed}.csv", some_records(60, seed), ends)
    write(tmp_path / "long.csv", ['1,"' + "words\n" * 200 + '",2', '3,"a\nb",4', "5,6,7"], ends)
    mine, whole = both(spark, str(tmp_path))
    assert len(mine) == 123
    if ends == "\n":
        assert mine == whole
    # Spark changes breaks within quotes if lines end in two characters; Python's reader keeps them.
    plain = []
    for path in tmp_path.iterdir():
        with open(path, encoding="ISO-8859-1", newline="") as file:
            plain += list(csv.reader(file))[1:]
    assert sorted([v or "" for v in row] for row in mine) == sorted(plain)
    pieces = read_quoted_csv(spark, str(tmp_path / "long.csv"), COLUMNS, "ISO-8859-1")
    assert pieces.rdd.getNumPartitions() > 5


def test_one_piece_a_file_and_no_last_break(spark, tmp_path):
    (tmp_path / "1.csv").write_text('a,b,c\n\n1,"x\n""y""",2\n  \n3,,""')
    mine = sorted_rows(read_quoted_csv(spark, str(tmp_path / "1.csv"), COLUMNS, "ISO-8859-1"))
    assert [tuple(r) for r in mine] == [("1", 'x\n"y"', "2"), ("3", None, None)]
    write(tmp_path / "2.csv", [])
    (tmp_path / "3.csv").write_text("")
    assert both(spark, str(tmp_path / "2.csv")) == ([], [])
    paths = [str(tmp_path / n) for n in ("1.csv", "2.csv", "3.csv")]
    assert sorted_rows(read_quoted_csv(spark, paths, COLUMNS, "ISO-8859-1")) == mine


@pytest.mark.parametrize(
    ("records", "header", "message"),
    [
        (['1,"x,2', "3,4,5"], "a,b,c", "left open"),
        (["1,2"], "a,b,c", "MALFORMED"),
        (["1,2,3,4"], "a,b,c", "MALFORMED"),
        (["1,2,3"], "a,c,b", "another header"),
        (['1,"' + "y" * 300 + '\n",2'], "a,b,c", "longer than"),
    ],
)
def test_what_cannot_be_read_fails(spark, tmp_path, records, header, message):
    path = write(tmp_path / "1.csv", records, header=header)
    with pytest.raises(Exception, match=message):
        read_quoted_csv(spark, path, COLUMNS, "ISO-8859-1", max_record=200).collect()


def test_sales_with_breaks_in_quotes(spark, tmp_path, small_pieces):
    header = "InvoiceNo,StockCode,Description,Quantity,UnitPrice,InvoiceDate,CustomerID,Country"
    lines = [f'K{i},M{i},"cup\nno. {i}, ""blue""",{i},1.5,2011-01-{i % 28 + 1:02},c{i},Norway' for i in range(90)]
    path = write(tmp_path / "1.csv", lines, header=header)
    mine = read_sales_csv(spark, path, multi_line=True, strict_quotes=True)
    assert mine.rdd.getNumPartitions() > 10
    assert sorted_rows(mine) == sorted_rows(read_sales_csv(spark, path, multi_line=True))
