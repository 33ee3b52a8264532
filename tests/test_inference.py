import pytest
from pyspark.sql import functions as F

from vellumark.functions import kinds
from vellumark.functions.values import SPACE
from vellumark.operators.inference import (
    FLAVOURS,
    infer_json,
    infer_relational,
    infer_xsd,
    merged_states,
    type_states,
)
from vellumark.sources.csv_tables import read_csv_folder, read_csv_strings, valid_rows

DATES = """2020-01|12:30|10/2025|1-1-1|2020-01-01|2020-1-1|01/02/2020|13/02/2020|1/2/20|31/12/99|2020/01/02|2020/1
1-2-2020|12-31-2020|2020-01-01T10:00:00|2020-01-01T10:00:00Z|2020-01-01T10:00:00+02:00|12:30:15.5|23:59|5-Jan-2020
Jan-2020|January-2020|05-JAN-20|2020-01-01 10:00|2020-01-01 10:00:00+00|2020-01-01 10:00 PM|10:30 AM|5/Jan/2020
Mon, 05 Jan 2020 10:00:00|Jan 5, 2020 10:00| 2020-01-01 |2020-01-01T10|1998-10-03T00:00:00.000"""
OTHERS = """-5|-5.5|1-2|1/2|a-b|AB-123|May-5|1:2:3|555-1234|1e-5|2020-13-01|2020-02-30|32-12-2020|24:00|1:2|Jan-20
99/99/99|13/2025|2025/13|2020-W01|2020-001|13:30PM|http://x.com|4-NOT SPECIFIED|5 Jan 2020|20200101|123-45-6789"""


def values(spark, *cells):
    return spark.createDataFrame([(i, v) for i, v in enumerate(cells)], "n int, v string")


@pytest.mark.parametrize("text,want", [(DATES, True), (OTHERS, False)])
def test_dates(spark, text, want):
    cells = text.replace("\n", "|").split("|")
    df = values(spark, *cells).select("v", kinds.relational_kind(F.col("v")).alias("k"))
    assert [r.v for r in df.collect() if (r.k == "date") != want] == []


@pytest.mark.parametrize(
    "cells,lax,strict",
    [
        (["5", "2020-01-01", "x"], "DATE", "DATE"),
        (["x", "2020-01-01"], "VARCHAR", "VARCHAR"),
        (["1", "2.5"], "FLOAT", "FLOAT"),
        (["1", " 5 ", "1_000", "+7"], "INT", "INT"),
        ([None, "", "NA", "n/a"], "INT", "INT"),
        (["1e5"], "VARCHAR", "VARCHAR"),
        (["1e-5"], "FLOAT", "FLOAT"),
        (["inf"], "FLOAT", "FLOAT"),
        (["1.2.3"], "FLOAT", "VARCHAR"),
        (["a@b.org"], "FLOAT", "VARCHAR"),
        (["-5"], "INT", "INT"),
        (["1", "abc", "2.5"], "VARCHAR", "VARCHAR"),
        ([], "INT", "INT"),
    ],
)
def test_relational(spark, cells, lax, strict):
    df = values(spark, *cells)
    assert infer_relational(df, "t", False, ["n"]).first().type == lax
    assert infer_relational(df, "t", True, ["n"]).first().type == strict


def test_a_cell_is_stripped_once(spark):
    plan = type_states(values(spark, "1", " x "), "t", ["n"])._jdf.queryExecution().executedPlan().toString()
    assert 1 <= plan.count("trim(") <= 2  # the plan is adaptive and may be shown with the initial one


def test_stripped_cells_give_the_same_classes(spark):
    odd = ["\u2028", "\x85", "12:30\u2028", "\u30002020-01-01", "3-MEDIUM", "5-Jan-2020 10:30 pm", "10:30 PM ", "2020-01-01T10Z", "4-NOT SPECIFIED"]
    cells = [*DATES.replace("\n", "|").split("|"), *OTHERS.replace("\n", "|").split("|"), *odd, None, "", " ", "+7", " 1_000", "1e-5 ", "inf", "nan ", "a.b"]
    df = values(spark, *cells).withColumn("t", F.btrim("v", F.lit(SPACE)))
    text = F.col("t")
    dated = (F.contains("v", F.lit("-")) | F.contains("v", F.lit("/")) | F.contains("v", F.lit(":"))) & text.rlike(f"^(?:{kinds.DATE})$")
    pairs = [(f(F.col("v")), f(F.col("v"), text)) for f in (kinds.relational_class, kinds.json_kind, kinds.xsd_kind)]
    rows = df.select("v", F.coalesce(dated, F.lit(False)).alias("dated"), *[p.eqNullSafe(q).alias(f"same{i}") for i, (p, q) in enumerate(pairs)], pairs[0][0].alias("class")).collect()
    assert [r.v for r in rows if not (r.same0 and r.same1 and r.same2) or (r["class"] == kinds.DATED) != r.dated] == []


def test_json_and_xsd(spark):
    df = spark.createDataFrame(
        [("1", "2020-01-01", "2020-01-01T10:00:00", "", "a.txt"), ("x", "1.5", "2020-01-01", None, None)],
        "id string, d string, type string, blank string, files string",
    )
    assert [r.type for r in infer_json(df, "t").collect()] == ["number", "date", "date-time", "string", "string"]
    got = infer_xsd(df, "t").collect()
    assert [(r.name, r.type) for r in got] == [
        ("id", "xs:long"), ("d", "xs:date"), ("type_field", "xs:date"), ("blank", "xs:string"),
        ("files", "attachment"),
    ]


def test_csv_edge_rows(spark, tmp_path):
    (tmp_path / "S_T.csv").write_text('a b,c,d\n1,"x\ny",3\nshort\nw,i,d,e\n,,\n"q""t",<&>,é\n', encoding="utf-8")
    (tmp_path / "S_EMPTY.csv").write_text("a,b\n")
    tables = read_csv_folder(spark, str(tmp_path), with_order=True)
    assert list(tables) == ["S_EMPTY", "S_T"]
    rows = [tuple(r)[:3] for r in read_csv_strings(spark, str(tmp_path / "S_T.csv")).collect()]
    assert rows == [("1", "x\ny", "3"), ("short", None, None), ("w", "i", "d"), (None, None, None), ('q"t', "<&>", "é")]
    assert valid_rows(tables["S_T"]).count() == 4
    assert [r.type for r in infer_relational(tables["S_EMPTY"], "e").collect()] == ["INT", "INT"]
    assert {r.record_count for r in infer_relational(tables["S_T"], "t").collect()} == {5}


def test_states_of_new_files_merge(spark, tmp_path):
    one, two = tmp_path / "one", tmp_path / "two"
    for folder in (one, two):
        folder.mkdir()
    (one / "a.csv").write_text("id,day,mix,mail\n1,2020-01-01,5,\n2,,6,x@y.org\n")
    (two / "b.csv").write_text('id,day,mix,mail\n3,later,"open\nline",\n4,2020-01-02,2020-01-01,1.5\n')
    whole = tmp_path / "whole"
    whole.mkdir()
    for f in (one / "a.csv", two / "b.csv"):
        (whole / f.name).write_text(f.read_text())

    def states(folder):
        return type_states(read_csv_strings(spark, str(folder), with_order=True), "t")

    def rows(df):
        return sorted(tuple(r) for r in df.collect())

    merged = merged_states(states(one), states(two))
    for name, flavour in FLAVOURS.items():
        assert rows(flavour(merged)) == rows(flavour(states(whole))), name
    assert [r.type for r in FLAVOURS["strict"](merged).orderBy("ordinal").collect()] == ["INT", "DATE", "VARCHAR", "VARCHAR"]
    again = merged_states(merged, states(two))  # a file counts once
    assert rows(FLAVOURS["json"](again)) == rows(FLAVOURS["json"](merged))


def test_states_of_no_rows_and_of_one_flavour(spark):
    none = values(spark)
    for flavour in FLAVOURS.values():
        assert [(r.name, r.record_count) for r in flavour(type_states(none, "t", ["n"])).collect()] == [("v", 0)]
    df = values(spark, "2020-01-01T10:00:00Z")
    assert FLAVOURS["json"](type_states(df, "t", ["n"], ["json"])).first().type == "date-time"
