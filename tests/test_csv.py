"""CSV fields by RFC 4180: quotes, line breaks, empty against missing."""

from tabulon.session import shared_path
from tabulon.sources.csv import read_csv, write_csv


def test_csv_keeps_quotes_newlines_and_empty_texts(spark):
    rows = [(1, 'say "hi", twice'), (2, "two\nlines\r\nthree"), (3, ""), (4, None), (5, '"'), (6, " pad "), (7, "\\")]
    path = write_csv(spark.createDataFrame(rows, "id int, v string"), shared_path(spark, "csv", unique=True))
    got = sorted(tuple(r) for r in read_csv(spark, path, "id int, v string", line_sep="\n").collect())
    assert got == rows


def test_csv_written_by_other_tools(spark):
    path = shared_path(spark, "csv_text", unique=True)
    spark.createDataFrame([('id,v\n1,"a ""b"" c"\n2,"x\ny"\n3,\n4,""\n',)], "value string").write.text(path)
    got = sorted(tuple(r) for r in read_csv(spark, path, "id int, v string").collect())
    assert got == [(1, 'a "b" c'), (2, "x\ny"), (3, None), (4, "")]
