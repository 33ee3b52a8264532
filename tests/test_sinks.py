import hashlib
import sys
import xml.etree.ElementTree as ET

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from vellumark.operators.aggregates import delivery_totals
from vellumark.operators.inference import infer_relational
from vellumark.operators.row_numbers import assign_chunks
from vellumark.session import new_folder
from vellumark.sinks import ledger, tables
from vellumark.sinks.xml_chunks import chunk_documents, read_chunk_rows, write_rows_xml
from vellumark.sources.csv_tables import read_csv_strings, write_csv
from vellumark.streaming.export import export_stream
from vellumark.streaming.intake import csv_stream, take_files

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def flaky(payload, attempt):
    """Accepts at once, at the second try, or never, by the payload."""
    digit = int(hashlib.sha256(payload.encode()).hexdigest()[0], 16)
    return 503 if digit < 4 or (digit < 8 and attempt == 1) else 201


def accepting(payload, attempt):
    return 201


def unreachable(payload, attempt):
    raise ConnectionError("no route")


def people(spark):
    rows = [("1", "a & b", "x<y"), ("2", None, ""), ("3", "é\n", '"q"'), ("4", "z", "w"), ("5", "v", "u")]
    return spark.createDataFrame(rows, "id string, `full name` string, note string")


def test_chunk_xml_equals_element_tree(spark):
    docs = chunk_documents(people(spark), "S", "T", [F.col("id")], 2).orderBy("chunk_id").collect()
    assert [d.rows for d in docs] == [2, 2, 1]
    rows = people(spark).collect()
    for d in docs:
        root = ET.Element("S")
        table = ET.SubElement(root, "T")
        for r in rows[d.chunk_id * 2 : d.chunk_id * 2 + 2]:
            e = ET.SubElement(table, "ROW")
            for k, v in r.asDict().items():
                ET.SubElement(e, k.strip().replace(" ", "_")).text = v or ""
        want = ET.tostring(root, encoding="utf-8").decode()
        assert d.payload == want
        assert (d.bytes, d.sha) == (len(want.encode()), hashlib.sha256(want.encode()).hexdigest())


def test_chunk_rows_read_back(spark):
    docs = chunk_documents(people(spark), "S", "T", [F.col("id")], 2)
    back = read_chunk_rows(docs, ["id", "full name", "note"]).orderBy("chunk_id", "n")
    assert [r.full_name for r in back.collect()][:2] == ["a & b", ""]


def test_bulk_xml_reads_back(spark, tmp_path):
    path = write_rows_xml(people(spark), str(tmp_path / "x"), "S", "T")
    assert spark.read.format("xml").option("rowTag", "ROW").load(path).count() == 5


def test_source_order_of_many_files(spark, tmp_path):
    df = spark.range(1000).select(F.col("id").cast("string"))
    path = write_csv(df.repartitionByRange(4, F.col("id").cast("int")).sortWithinPartitions(F.col("id").cast("int")), str(tmp_path / "c"))
    rows = assign_chunks(read_csv_strings(spark, path, with_order=True), None, 7)
    assert [int(r.id) for r in rows.orderBy("position").collect()] == list(range(1000))


def test_ledger_is_resumable(spark, tmp_path):
    docs = chunk_documents(spark.range(400).selectExpr("id", "id * 7 AS v"), "S", "T", [F.col("id")], 10)
    nothing = ledger.deliver(docs, str(tmp_path / "none"), unreachable)
    assert {(r.status, r.attempt) for r in nothing.collect()} == {(0, 3)}
    path = str(tmp_path / "ledger")
    first = ledger.deliver(docs, path, flaky).collect()
    assert len(first) == 40
    failed = {r.chunk_id for r in first if r.status != 201}
    assert failed and {r.attempt for r in first} == {1, 2, 3}
    again = ledger.deliver(docs, path, accepting)
    assert again.count() == 40 + len(failed)
    assert ledger.deliver(docs, path, accepting).count() == 40 + len(failed)
    assert ledger.latest_status(again).filter("status = 201").agg(F.sum("rows")).first()[0] == 400


def test_totals_follow_the_content(spark, tmp_path):
    path = str(tmp_path / "ledger")
    first = chunk_documents(spark.range(50).selectExpr("id", "id * 7 AS v"), "S", "T", [F.col("id")], 10)
    ledger.deliver(first, path, accepting)
    changed = chunk_documents(spark.range(32).selectExpr("id", "id * 9 AS v"), "S", "T", [F.col("id")], 10)
    entries = ledger.deliver(changed, path, unreachable)
    assert tuple(delivery_totals(entries, first).first()) == (50, 50, 0)
    assert tuple(delivery_totals(entries, changed).first()) == (32, 0, 32)
    assert tuple(delivery_totals(entries).first()) == (82, 50, 32)
    assert {r.status for r in ledger.latest_status(entries, changed).collect()} == {0}
    assert ledger.latest_status(entries, changed).count() == 4


def test_streams_without_files(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    stream = csv_stream(spark, str(folder), ["a", "b"])
    taken = take_files(stream, str(tmp_path / "c1"), str(tmp_path / "out"))
    assert taken.count() == 0 and taken.columns == ["a", "b", "_file", "batch_id"]
    out = export_stream(stream, str(tmp_path / "c2"), str(tmp_path / "ledger"), accepting, "S", "T")
    assert out.count() == 0


def test_metrics_are_unique(spark, tmp_path):
    totals = spark.createDataFrame([(10, 8, 2)], "rows_in_chunks long, rows_delivered long, rows_failed long")
    run = ledger.run_metrics(totals, "d", "r1", "2025-07-09 10:00:00+00")
    path = str(tmp_path / "m")
    ledger.append_metrics(run, path)
    assert ledger.append_metrics(run, path).count() == 1
    more = run.withColumn("run_id", F.explode(F.array(F.lit("r0"), F.lit("r1"), F.lit("r2")))).drop("records_failed")
    rows = ledger.append_metrics(more, path).orderBy("id").collect()
    assert [(r.id, r.run_id, r.records_failed) for r in rows] == [(1, "r1", 2), (2, "r0", 0), (3, "r2", 0)]
    assert all(r.recorded_at and r.reserved5 is None for r in rows)


def test_upsert_modes(spark):
    schema = "id long, name string, role string, created_at string, updated_at string"
    current = spark.createDataFrame([(1, "a", "admin", "c1", "u1"), (2, "b", "user", "c2", "u2")], schema)
    incoming = spark.createDataFrame(
        [(2, "b2", None, "c9", "u9", 1), (2, "b3", None, "c9", "u9", 2), (3, "c", None, "c3", "u3", 1)],
        schema + ", seq int",
    )

    def run(mode, **kw):
        out = tables.upsert(current, incoming, ["id"], mode, "seq", {"role": "user"}, **kw)
        return [tuple(r) for r in out.orderBy("id").collect()]

    assert run("update", updated_at=F.lit("now"), keep=["created_at"]) == [
        (1, "a", "admin", "c1", "u1"), (2, "b3", "user", "c2", "now"), (3, "c", "user", "c3", "u3"),
    ]
    assert run("ignore")[1] == (2, "b", "user", "c2", "u2")
    assert run("replace")[1] == (2, "b3", "user", "c9", "u9")


def test_replace_load_switches_all_tables(spark, tmp_path):
    root = str(tmp_path)
    tables.replace_load({"a": spark.range(3), "b": spark.range(4)}, root)
    tables.replace_load({"a": spark.range(5), "b": spark.range(6)}, root)
    assert tables.read_loaded(spark, root, "a").count() == 5
    assert tables.read_loaded(spark, root, "b").count() == 6


def test_reports(spark, tmp_path):
    small = spark.createDataFrame([("x", 1), (None, 2)], "label string, count long")
    assert tables.report_document(small).first()[0] == '{"label":[null,"x"],"count":[2,1]}'
    assert tables.report_document(small, "records").first()[0] == '[{"label":null,"count":2},{"label":"x","count":1}]'
    assert tables.report_document(small.filter("count = 1"), "mapping").first()[0] == '{"x":1}'
    assert tables.report_document(small.filter("count = 1"), "object").first()[0] == '{"label":"x","count":1}'
    for n in (9_999, 10_001):  # one form, whatever the length
        long = spark.range(n).selectExpr("id", "id * 2 AS double")
        assert tables.report_document(long, "records").count() == 1
        assert tables.report_document(long, "object").count() == n
    summary = tables.write_reports({"one": tables.report_document(small)}, str(tmp_path), "2025-01-01T00:00:00").first()
    assert summary.analyses.one.endswith("/one")
    assert not tables.dump_csv(spark.range(0), str(tmp_path / "none"))


def test_stream_takes_each_file_once(spark, tmp_path):
    src = str(tmp_path / "in")
    write_csv(spark.range(90).select(F.col("id").cast("string")).repartition(6), src)
    def run():
        return take_files(csv_stream(spark, src, ["id"], 2), str(tmp_path / "cp"), str(tmp_path / "out"))
    assert run().count() == 90
    extra = spark.range(90, 100).select(F.col("id").cast("string")).coalesce(1)
    extra.write.mode("append").options(header="true").csv(src)
    assert run().select("id").distinct().count() == 100
    assert run().count() == 100


def test_stream_export_resumes(spark, tmp_path):
    src = str(tmp_path / "in")
    write_csv(spark.range(100).select(F.col("id").cast("string")).repartition(4), src)
    def run(cp, transport):
        stream = csv_stream(spark, src, ["id"], 2)
        return export_stream(stream, str(tmp_path / cp), str(tmp_path / "ledger"), transport, "S", "T", 10)
    assert run("cp", accepting).agg(F.sum("rows")).first()[0] == 100
    before = run("cp", accepting).count()
    # A lost checkpoint repeats the batches, but the ledger knows their chunks.
    assert run("cp2", accepting).count() == before


def test_folder_names_are_unused(spark):
    assert new_folder(spark, "a") != new_folder(spark, "a")


def test_source_order_of_a_split_file(spark, tmp_path):
    path = tmp_path / "one.csv"
    path.write_text("id,v\n" + "".join(f"{i},{'x' * (i % 37)}\n" for i in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "30000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = read_csv_strings(spark, str(path), multi_line=False, with_order=True)
        assert df.rdd.getNumPartitions() > 5
        rows = assign_chunks(df, None, 999).orderBy("position").collect()
        kinds = infer_relational(df.withColumn("m", F.when(F.col("id") == "12345", "x").otherwise("2020-01-01")), "t")
        assert {r["name"]: r.type for r in kinds.collect()} == {"id": "INT", "v": "VARCHAR", "m": "DATE"}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [int(r.id) for r in rows] == list(range(20_000))
    assert [r.chunk_id for r in rows] == [i // 999 for i in range(20_000)]


def test_finished_files_are_archived(spark, tmp_path):
    src, archive = str(tmp_path / "in"), tmp_path / "done"

    def run():
        stream = csv_stream(spark, src, ["id"], 1, archive=str(archive))
        return take_files(stream, str(tmp_path / "cp"), str(tmp_path / "out"))

    for at in (0, 10):
        part = spark.range(at, at + 10).select(F.col("id").cast("string")).coalesce(1)
        part.write.mode("append").options(header="true").csv(src)
        assert run().count() == at + 10
    # A file goes to the archive with a batch after its own.
    assert len([p for p in archive.rglob("*.csv")]) >= 1


def test_columns_may_have_any_name(spark):
    df = spark.createDataFrame([(1, "a", "b", "c")], "k int, position string, `chunk_id` string, `x.y` string")
    payload = chunk_documents(df, "S", "T", [F.col("k")], 5).first().payload
    assert payload == "<S><T><ROW><k>1</k><position>a</position><chunk_id>b</chunk_id><x.y>c</x.y></ROW></T></S>"
    with pytest.raises(ValueError):
        assign_chunks(df, ["k"], 5)
