"""Quoted line breaks in CSV files that many tasks read, against Spark's whole-file reader."""

import csv
import io
import os

import numpy as np
import pytest

from vellumark.operators.row_numbers import SOURCE_ORDER, number_rows
from vellumark.sources import csv_records, csv_tables

CELLS = [
    "", "plain", "two\nlines", 'say "hi"', ",", '"', '""', "a,b\nc,d", "\n", "\n\n", "  space ", "é,日本\n語", 'x"y', "1.5", "null", '",\n"', "end\n",
]


@pytest.fixture()
def small_blocks(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def written(path, rows, header=("a", "b c", "d"), end="\n"):
    out = io.StringIO()
    w = csv.writer(out, lineterminator=end)
    w.writerow(header)
    w.writerows(rows)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(out.getvalue())
    return str(path)


def made(n, seed, cells=CELLS):
    draw = np.random.default_rng(seed)
    return [[cells[draw.integers(0, len(cells))] for _ in range(3)] for _ in range(n)]


def whole_file(spark, path):
    return spark.read.options(header="true", escape='"', multiLine="true").csv(path)


def same_in_order(spark, path):
    want = [tuple(r) for r in whole_file(spark, path).collect()]
    df = csv_tables.read_csv_strings(spark, path, with_order=True)
    got = [tuple(r)[: len(df.columns) - 3] for r in df.orderBy(*SOURCE_ORDER).collect()]
    assert got == want
    return df


@pytest.mark.parametrize("seed", range(4))
def test_equals_whole_file_reading(spark, tmp_path, small_blocks, seed):
    path = written(tmp_path / "S_T.csv", made(200, seed))
    df = same_in_order(spark, path)
    assert csv_records.lines(spark, path).rdd.getNumPartitions() > 3
    numbered = number_rows(df).orderBy("position").collect()
    assert [r["position"] for r in numbered] == list(range(len(numbered)))
    assert [r["d"] for r in numbered] == [r["d"] for r in whole_file(spark, path).collect()]


def test_records_longer_than_blocks(spark, tmp_path, small_blocks):
    long = "".join(f"line {i}, of many\n" for i in range(200))
    rows = [["1", long, "x"], ["2", "", long], ["3", "plain", "y"], ["4", 'quote "' + long + '"', ""]]
    same_in_order(spark, written(tmp_path / "S_L.csv", rows))


def test_line_ends_headers_and_odd_cells(spark, tmp_path, small_blocks):
    plain = [c for c in CELLS if "\n" not in c]
    same_in_order(spark, written(tmp_path / "crlf.csv", made(50, 9, plain), end="\r\n"))
    same_in_order(spark, written(tmp_path / "head.csv", made(30, 8), header=("a\nb", 'c"', "d,e")))
    same_in_order(spark, written(tmp_path / "none.csv", []))
    short = tmp_path / "short.csv"
    short.write_text('a,b,c\n1\n\n2,"x\ny",3,4\n"open, and never\nclosed,5\n')
    df = csv_tables.read_csv_strings(spark, str(short), with_order=True)
    assert [tuple(r)[:2] for r in df.orderBy(*SOURCE_ORDER).collect()][:2] == [("1", None), ("2", "x\ny")]


def test_quotes_inside_unquoted_cells_do_not_open(spark, tmp_path, small_blocks):
    path = tmp_path / "inch.csv"
    path.write_text("a,b,c\n" + '5" disk,3" tape,"a\nb"\n' * 60 + 'x,y 2",z\n' * 60)
    same_in_order(spark, str(path))


def test_without_spanning_records_spark_splits(spark, tmp_path, small_blocks):
    path = written(tmp_path / "flat.csv", made(300, 1, [c for c in CELLS if "\n" not in c]))
    df = same_in_order(spark, path)
    assert "FileScan csv" in df._jdf.queryExecution().toString()
    assert df.rdd.getNumPartitions() > 3


def test_folder_of_files_and_given_columns(spark, tmp_path, small_blocks):
    os.mkdir(tmp_path / "T.csv")
    rows = []
    for k in range(5):
        part = made(40, 20 + k)
        written(tmp_path / "T.csv" / f"part-{k}.csv", part)
        rows += part
    df = csv_tables.read_csv_strings(spark, str(tmp_path / "T.csv"), with_order=True, columns=["x", "y", "z"])
    got = [tuple(r)[:3] for r in df.orderBy(*SOURCE_ORDER).collect()]
    kept = [tuple(c or None for c in r) for r in rows]
    assert df.columns[:3] == ["x", "y", "z"]
    assert [tuple(c or None for c in g) for g in got] == kept


def test_starts_of_blocks_without_broadcast(spark, tmp_path, small_blocks):
    path = written(tmp_path / "S_J.csv", made(150, 3))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        same_in_order(spark, path)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_lone_carriage_returns(spark, tmp_path, small_blocks):
    ends = tmp_path / "cr.csv"
    ends.write_bytes(b'a,b\r1,"x"\r2,y\r')
    inside = tmp_path / "in.csv"
    inside.write_bytes(b'a,b\n1,"x\ry"\n2,"z\nw"\n')
    for path in (ends, inside):
        same_in_order(spark, str(path))
