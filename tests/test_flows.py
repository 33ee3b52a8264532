import csv
import json
import random
import sys
import zipfile

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from vellumark.plans import flows
from vellumark.session import shared_root

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def refuses_second(payload, attempt):
    return 500 if "<id>3</id>" in payload else 201


def accepts(payload, attempt):
    return 201


def write_rows(path, rows):
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f).writerows(rows)
    return str(path)


def test_archive_table(spark, tmp_path):
    path = write_rows(tmp_path / "S_T.csv", [["id", "a b"], *[[i, f"v\n{i}"] for i in range(7)]])
    def run(run_id, transport):
        return flows.archive_table(
            spark, path, transport, str(tmp_path / "w"), "d", run_id, "2025-07-09 10:00:00+00", chunk_rows=2
        )
    ledger, metrics = run("r1", refuses_second)
    assert {r.chunk_id: (r.rows, r.status, r.attempt) for r in ledger.collect()} == {
        0: (2, 201, 1), 1: (2, 500, 3), 2: (2, 201, 1), 3: (1, 201, 1),
    }
    assert [(r.records_processed, r.records_successful, r.records_failed) for r in metrics.collect()] == [(7, 5, 2)]
    ledger, metrics = run("r2", accepts)
    assert {r.status for r in ledger.collect()} == {201}
    assert {r.run_id: r.records_failed for r in metrics.collect()} == {"r1": 2, "r2": 0}


def test_describe_folder(spark, tmp_path):
    (tmp_path / "in").mkdir()
    write_rows(tmp_path / "in" / "S_A.csv", [["CustomerID", "day", "Attachments"], ["1", "2020-01-01", "x;y"]])
    write_rows(tmp_path / "in" / "S_B.csv", [["v", "type"], ["1.5", "t"], ["2", ""]])
    made = flows.describe_folder(spark, str(tmp_path / "in"), str(tmp_path / "out"), "App", "Cards")
    document = json.loads(made["metadata_json"].first().document)
    assert [t["table_name"] for t in document["tables"]] == ["S_A", "S_B"]
    assert [c["type"] for c in document["tables"][0]["columns"]] == ["INT", "DATE", "VARCHAR"]
    assert "<tableCount>2</tableCount>" in made["metadata_xml"].first().document
    schemas = {r.table_name: json.loads(r.document) for r in made["json_schemas"].collect()}
    record = schemas["S_A"]["properties"]["Record"]
    assert record["xsd_sequence"] == ["CustomerID", "day", "Attachments"]
    assert record["properties"]["Attachments"]["properties"]["Attachment"]["properties"]["Size"] == {"type": "number"}
    assert made["xsd"].count() == made["xsd_from_json"].count() == 2


def test_build_packages(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(6):
        (tmp_path / "in" / f"f{i}.txt").write_text("x" * 100 * i)
    rows = [["CustomerID", "Attachment", "second attachment", "position"]]
    rows += [[i, f"/old/f{i}.txt", "f0.txt" if i % 2 else "", "p"] for i in range(6)]
    rows.insert(3, ["", "", "", ""])
    path = write_rows(tmp_path / "r.csv", rows)
    def run(out):
        made = flows.build_packages(
            spark, path, str(tmp_path / "in"), str(tmp_path / out), "Cards", "App", "2025-07-09T12:00:00", records=3
        )
        return made.orderBy("package_id").collect()
    made = run("zips")
    assert [(r.package_id, r.files, r.error) for r in made] == [(0, 4, None), (1, 6, None), (2, 4, None)]
    with zipfile.ZipFile(made[0].path) as z:
        payload = z.read("eas_pdi.xml").decode()
        assert payload.count("<Record>") == 2 and "<aiu_count>2</aiu_count>" in z.read("eas_sip.xml").decode()
    write_rows(tmp_path / "r.csv", [*rows, ["9", "gone.txt", "", ""]])
    assert [r.error for r in run("zips2")][-1] == "missing attachment: gone.txt"


def test_packages_of_unfit_records(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "f.txt").write_text("x")
    rows = [["Customer ID", "type", "Attachment"]] + [[i if i != 4 else "four", "t", "f.txt"] for i in range(6)]
    path = write_rows(tmp_path / "r.csv", rows)
    def run(out, types):
        made = flows.build_packages(
            spark, path, str(tmp_path / "in"), str(tmp_path / out), "Cards", "App", "2025-07-09T12:00:00", records=2, types=types
        )
        return [(r.files, r.error) for r in made.orderBy("package_id").collect()]
    assert run("all", {"Customer ID": "xs:string", "type": "xs:string"}) == [(3, None)] * 3
    assert run("some", {"Customer ID": "xs:long", "type": "xs:string"}) == [
        (3, None), (3, None), (0, "1 records do not fit the XSD"),
    ]


def test_report_metadata(spark, tmp_path):
    rnd = random.Random(4)
    rows = [
        (f"f{i}", "/d", rnd.choice(["a", None]), "final", rnd.choice(["x", "y", None]), "5y", "1", "c", rnd.choice("uv"), 2000 + i % 20)
        for i in range(120)
    ]
    df = spark.createDataFrame(
        rows,
        "filename string, folder_path string, document_type string, document_status string, sensitivity_labels string, "
        "retention_policies string, version string, creator string, modifier string, year int",
    ).withColumns({"creation_date": F.make_date("year", F.lit(1), F.lit(1)).cast("timestamp_ntz"), "last_modified": F.lit("t")})
    summary = flows.report_metadata(df, str(tmp_path / "r"), "2020-01-02 00:00:00").first()
    assert len(summary.analyses) == 11
    ages = json.loads(spark.read.text(summary.analyses.document_age).first()[0])
    assert ages["age_bins"][0] == "0-1" and sum(ages["counts"]) == 30
    complete = json.loads(spark.read.text(summary.analyses.metadata_completeness).first()[0])
    assert complete["creator"] == 100.0 and set(complete) == {"document_type", "creator", "retention_policy"}
    months = json.loads(spark.read.text(summary.analyses.monthly_growth).first()[0])
    assert months[0] == {"month": "2000-01", "new_docs": 6, "cumulative_total": 6}
    labels = [json.loads(r[0]) for r in spark.read.text(summary.analyses.sensitivity_label_recommendations).collect()]
    assert {r["filename"] for r in labels} == {r[0] for r in rows if r[4] is None}
    status = json.loads(spark.read.text(summary.analyses.document_status).first()[0])
    assert status == {"labels": ["final"], "counts": [120], "percentages": [100.0]}


def test_prepare_and_enrich(spark, tmp_path):
    docs = tmp_path / "docs"
    docs.mkdir()
    for i in range(4):
        (docs / f"d{i}.txt").write_text(f"# One\nPlease use the blue ship number {i}.\n# Two\nMail a{i}@b.example.org by 2024-01-0{i + 1}.")
    (docs / "p.txt").write_bytes(b"%PDF-1.7")
    points = flows.prepare_documents(spark, str(docs), str(tmp_path / "c"), "v1")
    assert points.count() == 8
    assert flows.prepare_documents(spark, str(docs), str(tmp_path / "c"), "v2", "v1").count() == 8
    places = spark.createDataFrame([("blue",)], "name string")
    def run():
        return flows.enrich_documents(spark, str(docs), str(tmp_path / "e"), places, documents=3)
    first = {r.filename: r for r in run().collect()}
    assert sorted(first) == ["d0.txt", "d1.txt", "d2.txt"]
    row = first["d1.txt"]
    assert row.pii_entities == "email: a1@b.example.org" and row.intent == "instruction"
    assert "date: 2024-01-02" in row.named_entities and "place: blue" in row.named_entities
    assert row.summary and row.keywords and row.topic and row.created_at
    assert sorted(r.filename for r in run().collect())[3:] == ["d3.txt", "p.txt"]
    assert sorted(p.name for p in docs.iterdir())[0] == "d0_Processed.txt"


def test_enrichment_of_an_empty_folder(spark, tmp_path):
    (tmp_path / "docs").mkdir()
    places = spark.createDataFrame([("x",)], "name string")
    assert flows.enrich_documents(spark, str(tmp_path / "docs"), str(tmp_path / "e"), places).count() == 0
    (tmp_path / "docs" / "a.txt").write_text("")
    row = flows.enrich_documents(spark, str(tmp_path / "docs"), str(tmp_path / "e"), places).first()
    assert (row.filename, row.summary, row.topic, row.intent) == ("a.txt", "", "", "unknown")


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="checkpoint"):
        shared_root(Session())
