"""Inferred types and rejected cells."""

import datetime as dt

from pyspark.sql import types as T

from hitlist.sources import inferred
from hitlist.sources.tables import read_csv


def _types(df):
    return {r.column_name: (r.type, r.n_values, r.n_empty) for r in inferred.inferred_types(df).collect()}


def test_types(spark):
    kind = "i string, big string, d string, day string, t string, none string, `odd name` string"
    rows = [
        ("1", "99999999999", "1.5", "2024-02-29", "x", None, "-7"),
        (" -3 ", "2147483647", "2", "1999-12-31", "4", "", "+0"),
        (None, "-1", "1e3", None, None, "  ", "12"),
    ]
    got = _types(spark.createDataFrame(rows, kind))
    assert got == {
        "i": ("int", 2, 1), "big": ("bigint", 3, 0), "d": ("double", 3, 0), "day": ("date", 2, 1), "t": ("string", 2, 1),
        "none": ("string", 0, 3), "odd name": ("int", 3, 0),
    }
    assert _types(spark.createDataFrame([], kind))["i"] == ("string", 0, 0)
    near = [("2147483648", "9223372036854775808", "1.2.3", "2023-02-29", "", "0x1", "1 2")]
    assert [v[0] for v in _types(spark.createDataFrame(near, kind)).values()] == ["bigint", "double", "string", "string", "string", "string", "string"]


def test_a_file_with_bad_cells(spark, tmp_path):
    lines = ['Date,Rank,Song', '2024-01-06,1,"A, b"', '06.01.2024,two,B', '2024-01-13,,C', '2024-01-13,3,', '2024-01-13,3,']
    (tmp_path / "chart.csv").write_text("\n".join(lines) + "\n")
    text = read_csv(spark, str(tmp_path / "chart.csv"), False)
    schema = T.StructType([T.StructField("Date", T.DateType()), T.StructField("Rank", T.IntegerType()), T.StructField("Song", T.StringType())])
    good = sorted(map(tuple, inferred.accepted(text, schema).collect()), key=str)
    assert good == sorted(
        [(dt.date(2024, 1, 6), 1, "A, b"), (dt.date(2024, 1, 13), None, "C"), *[(dt.date(2024, 1, 13), 3, None)] * 2], key=str
    )
    bad = sorted(map(tuple, inferred.rejected(text, schema).collect()))
    assert bad == [("Date", "not date", "06.01.2024", "06.01.2024", "two", "B"), ("Rank", "not int", "two", "06.01.2024", "two", "B")]
    assert [f.dataType.simpleString() for f in inferred.typed_schema(text).fields] == ["string", "string", "string"]
    fine = text.filter("Song IS NOT NULL AND Rank IS DISTINCT FROM 'two'")
    assert [f.dataType.simpleString() for f in inferred.typed_schema(fine).fields] == ["date", "int", "string"]
    assert inferred.accepted(text.limit(0), schema).count() == inferred.rejected(text.limit(0), schema).count() == 0


def test_types_are_one_pass(spark):
    df = spark.range(10).selectExpr("cast(id as string) as a", "cast(id as string) as b")
    plan = inferred.inferred_types(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range") == 1


def test_each_cell_is_read_once(spark):
    text = spark.createDataFrame([("1", "x", "2024-01-06")], "n string, t string, day string")
    schema = T.StructType.fromDDL("n int, t string, day date")
    for read in (inferred.accepted, inferred.rejected):
        plan = read(text, schema)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("RLIKE") == 2 and plan.count("try_cast") == 2 and "regexp_replace" not in plan


def test_white_space_and_odd_cells(spark):
    white = " \t\n\x0b\f\r"
    rows = [
        (f"{white}5{white}", "a", f"\r\n2024-01-06{white}"),
        (white, None, None),
        ("", " b ", white),
        ("\u00a05", "c", None),  # no-break space and control characters are no white space
        ("\x0b\x005", "d", None),
        ("5 5", "e", "2024-02-30"),
        ("5\u2028", "f", None),
    ]
    text = spark.createDataFrame(rows, "n string, t string, day string")
    schema = T.StructType.fromDDL("n int, t string, day date")
    good = sorted(map(tuple, inferred.accepted(text, schema).collect()), key=str)
    assert good == sorted([(5, "a", dt.date(2024, 1, 6)), (None, None, None), (None, " b ", None)], key=str)
    bad = sorted((r.column_name, r.reason, r.value, r.t) for r in inferred.rejected(text, schema).collect())
    assert bad == sorted(
        [("n", "not int", rows[k][0], rows[k][1]) for k in (3, 4, 5, 6)] + [("day", "not date", "2024-02-30", "e")]
    )
    assert _types(text)["n"] == ("string", 5, 2) and _types(text)["day"] == ("string", 2, 5)
