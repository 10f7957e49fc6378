import random

import pytest
from pyspark.sql import Row

from courtside.sources import csv_text as C
from courtside.sources.files import quarantine

ODD = [None, "", " ", "  padded ", "two\nlines", 'q"uo"te', '"', '""', ",", "a,b", "\\", '\\"', "\t", "x\r", "\r\n", "é漢🎉", "NULL", "\x01", "#c"]


def lines_file(tmp_path, lines, name="x.csv"):
    (tmp_path / name).write_text("\n".join(lines) + "\n", newline="")
    return str(tmp_path)


def test_every_value_comes_back(spark, tmp_path):
    r = random.Random(1)
    rows = [(i, *(r.choice(ODD) for _ in range(3))) for i in range(500)] + [(None, None, None, None), (501, "", "", "")]
    frame = spark.createDataFrame(rows, "a long, b string, `c,d` string, e string")
    path = str(tmp_path / "out")
    C.write(frame.repartition(3), path, rows_per_file=100)
    got = C.read_checked(spark, path, multi_line=True)
    assert sorted(map(str, map(tuple, got.rows.collect()))) == sorted(str((None if a is None else str(a), *more)) for a, *more in rows)
    assert got.rejects.count() == 0 and got.rows.columns == ["a", "b", "c,d", "e"]


def test_values_without_line_ends_come_back_by_line(spark, tmp_path):
    rows = [(str(i), x, y) for i, (x, y) in enumerate((x, y) for x in ODD for y in ODD) if not any(v and ("\n" in v or "\r" in v) for v in (x, y))]
    path = str(tmp_path / "out")
    C.write(spark.createDataFrame(rows, "a string, b string, c string"), path)
    got = C.read_checked(spark, path)
    assert sorted(map(str, map(tuple, got.rows.collect()))) == sorted(map(str, rows)) and got.rejects.count() == 0


def test_each_bad_line_is_reported_with_its_text(spark, tmp_path):
    good = ["1,x,y", '2,"a,b"," c "', "3,,", '4,"q""q",""', '5,"",z', "6,'x,y"]
    bad = {"7,x": "fields", "8,x,y,z": "fields", '9,"open,y': "quotes", '10,"x"junk,y': "quotes", '11,ju"nk,y': "quotes", "c,a,b": "header", '12,"a': "quotes", 'b",c': "quotes"}
    got = C.read_checked(spark, lines_file(tmp_path, ["a,b,c", *good, "", *bad, '"a","b","c"']), ["a", "c"])
    assert {r.text: r.reason for r in got.rejects.collect()} == bad
    assert all(r.file.endswith("x.csv") for r in got.rejects.collect())
    assert sorted(got.rows.collect()) == [Row(a="1", c="y"), Row(a="2", c=" c "), Row(a="3", c=None), Row(a="4", c=""), Row(a="5", c="z"), Row(a="6", c="y")]


def test_multi_line_reports_wrong_field_counts(spark, tmp_path):
    got = C.read_checked(spark, lines_file(tmp_path, ["a,b,c", '1,"x\ny",z', "2,x", "3,x,y,z", "4,,"]), multi_line=True)
    assert sorted(r.text for r in got.rejects.collect()) == ["2,x", "3,x,y,z"]
    assert sorted(map(tuple, got.rows.collect())) == [("1", "x\ny", "z"), ("4", None, None)]
    assert sorted(r.a for r in got.rows.select("a").collect()) == ["1", "4"]  # pruning does not hide bad records


def test_headers_are_checked(spark, tmp_path):
    path = lines_file(tmp_path, ["a,b", "1,2"])
    with pytest.raises(ValueError, match="missing|not in the header"):
        C.read_checked(spark, path, ["a", "z"])
    with pytest.raises(ValueError, match="repeated"):
        C.read_checked(spark, lines_file(tmp_path, ["a,A", "1,2"], "twice.csv") + "/twice.csv")
    assert C.read_checked(spark, lines_file(tmp_path, ["1,2", "3"], "plain.csv") + "/plain.csv", header=["x", "y"]).rows.collect() == [Row(x="1", y="2")]
    with pytest.raises(ValueError, match="blank line"):
        C.write(spark.range(3), str(tmp_path / "one"))


def test_long_and_many_quotes_in_a_line(spark, tmp_path):
    long, quotes = "x" * 300_000, '"' + '""' * 100_000 + '"'
    got = C.read_checked(spark, lines_file(tmp_path, ["a,b", f"1,{long}", f"2,{quotes}", f'3,"{long}']))
    assert sorted((r.a, len(r.b)) for r in got.rows.collect()) == [("1", 300_000), ("2", 100_000)]
    assert [(r.reason, len(r.text)) for r in got.rejects.collect()] == [("quotes", 300_003)]


def test_quarantine_counts_per_source(spark, tmp_path):
    landing = C.read_checked(spark, lines_file(tmp_path, ["a,b", "1,2", "3", "4,5,6"]))
    clean = C.Landing(landing.rows, landing.rejects.limit(0))
    out = str(tmp_path / "rejects")
    assert quarantine({"games": landing, "plays": clean}, out) == {"games": 2, "plays": 0}
    assert {(r.source, r.reason, r.text) for r in spark.read.parquet(out).collect()} == {("games", "fields", "3"), ("games", "fields", "4,5,6")}
