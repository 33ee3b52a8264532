import base64
import hashlib
import os
import xml.etree.ElementTree as ET
import zipfile

import pytest
from pyspark.sql import functions as F

from vellumark.functions.names import attachment_column, attachment_columns
from vellumark.operators import attachments as att
from vellumark.operators.packing import pack_greedy, package_summary
from vellumark.sinks.packages import with_package_files, write_packages
from vellumark.sources import files as sources
from vellumark.sources.files import newest_valid_zip, read_text_heads

FILES = {"a.txt": b"alpha", "b.pdf": b"%PDF-1.7 x", "empty.bin": b"", "copy.txt": b"alpha", "big.png": b"\x89PNG" + b"z" * 5000}
NS = "{urn:eas-samples:en:xsd:cards.1.0}"


@pytest.fixture()
def folder(tmp_path):
    path = tmp_path / "in"
    path.mkdir()
    for name, content in FILES.items():
        (path / name).write_bytes(content)
    return str(path)


def transactions(spark):
    rows = [
        (1, " 10 ", "O'Neil & <Co>", "x/a.txt", "b.pdf"),
        (2, "20", None, "", None),
        (3, "30", "n", "a.txt", "y/z/copy.txt"),
        (4, "40", "n", "big.png", None),
        (5, "50", "n", "empty.bin", " "),
    ]
    return spark.createDataFrame(rows, "n long, CustomerID string, Name string, Attachment1 string, attachment2 string")


def attachments(spark, folder):
    return sources.attachments(sources.list_files(spark, folder))


def check_zips(spark, folder):
    return sources.check_zips(sources.list_files(spark, folder))


def build(spark, folder, max_bytes=3 * 2048, rows=2):
    df = transactions(spark)
    files = attachments(spark, folder)
    matched = att.with_files(att.references(df, "n", ["Attachment1", "attachment2"]), files)
    packed = pack_greedy(att.record_sizes(df, "n", matched), ["n"], "size", max_bytes, rows)
    fragments = att.record_fragments(df, "n", ["CustomerID", "Name"], matched, "/in")
    docs = att.payloads(fragments, packed, "n", "Cards")
    return df, files, matched, packed, docs


def test_attachment_facts(spark, folder):
    got = {r["name"]: r for r in attachments(spark, folder).collect()}
    for name, content in FILES.items():
        digest = hashlib.sha256(content)
        assert got[name]["size"] == len(content)
        assert got[name]["checksum"] == base64.b64encode(digest.digest()).decode()
        assert got[name]["content_name"] == "ea_" + digest.hexdigest()
    assert [got[n]["mimetype"] for n in ("a.txt", "b.pdf", "empty.bin", "big.png")] == [
        "text/plain", "application/pdf", "application/octet-stream", "image/png",
    ]
    kinds = sources.document_kinds(sources.list_files(spark, folder))
    assert {r["name"]: r.kind for r in kinds.collect()} == {
        "a.txt": "text", "b.pdf": "pdf", "empty.bin": "text", "copy.txt": "text", "big.png": "image",
    }


def test_column_split():
    assert attachment_columns(["a", "My Attachment", "b"]) == (["a", "b"], ["My Attachment"])
    assert attachment_column(["x", "Attachments", "files"], "FILES") == "files"
    assert attachment_column(["x", "ATTACHMENT "]) == "ATTACHMENT "
    assert attachment_column(["x"]) is None


def test_payload_records(spark, folder):
    *_, docs = build(spark, folder)
    docs = docs.withColumn("counted", att.counted_records(F.col("payload"))).orderBy("package_id").collect()
    assert [(d.package_id, d.aiu_count, d.counted) for d in docs] == [(0, 2, 2), (1, 1, 1), (2, 1, 1), (3, 1, 1)]
    first = ET.fromstring(docs[0].payload)
    assert first.tag == NS + "Records"
    records = list(first)
    assert records[0].find(NS + "CustomerID").text == "10"
    assert records[0].find(NS + "Name").text == "O'Neil & <Co>"
    attached = records[0].find(NS + "Attachments")
    assert [a.find(NS + "EASFile").text for a in attached] == ["a.txt", "b.pdf"]
    assert attached[0].find(NS + "checksum").attrib == {"algorithm": "SHA-256", "encoding": "base64"}
    assert list(records[1].find(NS + "Attachments")) == []


def test_study_and_summary(spark, folder):
    df, files, matched, packed, _ = build(spark, folder)
    study = att.package_study(df, matched).first()
    assert (study.total_records, study.unique_attachments) == (5, 5)
    assert study.attachment_bytes == sum(map(len, FILES.values()))
    assert [r.records for r in package_summary(packed).orderBy("package_id").collect()] == [2, 1, 1, 1]
    broken = att.references(df.withColumn("Attachment1", F.lit("/x/none.txt")), "n", ["Attachment1"])
    assert [r["name"] for r in att.missing_files(broken, files).collect()] == ["none.txt"]


def test_zips(spark, folder, tmp_path):
    _, files, matched, packed, docs = build(spark, folder)
    docs = docs.withColumn("descriptor", F.lit("<sip/>"))
    refs = att.package_files(matched, packed, "n")
    out = str(tmp_path / "zips")

    def run(target=files, **kw):
        rows = write_packages(with_package_files(docs, refs, target), out, "Cards", **kw)
        return {r.package_id: r for r in rows.collect()}

    first = run()
    assert [first[i].files for i in range(4)] == [4, 4, 3, 3]
    for r in first.values():
        content = open(r.path, "rb").read()
        assert (r.bytes, r.sha) == (len(content), hashlib.sha256(content).hexdigest())
    with zipfile.ZipFile(first[0].path) as z:
        assert z.namelist() == ["eas_pdi.xml", "eas_sip.xml", "a.txt", "b.pdf"]
        assert z.read("b.pdf") == FILES["b.pdf"]
    assert {r.sha for r in run().values()} == {r.sha for r in first.values()}
    assert len([n for n in os.listdir(out) if n.endswith(".zip")]) == 4

    errors = run(files.filter("name <> 'a.txt'"))
    assert errors[0].error == "missing attachment: a.txt" and errors[3].error is None
    assert "exceed the limit" in run(limit=5000)[2].error

    cut = first[3].path.replace("Cards_3", "Cards_9")
    open(cut, "wb").write(open(first[3].path, "rb").read()[:-40])
    flipped = bytearray(open(first[2].path, "rb").read())
    flipped[60] ^= 255
    open(first[2].path.replace("Cards_2", "Cards_8"), "wb").write(flipped)
    os.utime(first[1].path, (2_000_000_000, 2_000_000_000))
    checked = check_zips(spark, out)
    assert checked.filter("valid").count() == 4 and checked.filter("not valid").count() == 2
    assert newest_valid_zip(checked).endswith(os.path.basename(first[1].path))


def test_no_valid_zip(spark, tmp_path):
    (tmp_path / "x.zip").write_bytes(b"nothing")
    with pytest.raises(FileNotFoundError):
        newest_valid_zip(check_zips(spark, str(tmp_path)))


def test_text_heads(spark, tmp_path):
    long = "".join(f"line {i}\n" for i in range(60))
    for name, text in {"b.txt": long, "a.txt": "", "c_Processed.txt": "x", "d.csv": "x", "e f.txt": "one\ntwo"}.items():
        (tmp_path / name).write_text(text)
    got = {r["name"]: r.head for r in read_text_heads(spark, str(tmp_path)).collect()}
    assert got == {"a.txt": "", "b.txt": "".join(f"line {i}\n" for i in range(50)), "e f.txt": "one\ntwo"}
    assert [r["name"] for r in read_text_heads(spark, str(tmp_path), 1).collect()] == ["a.txt"]


def test_referenced_files_are_found_without_a_listing(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "b").mkdir()
    for n in range(30):
        (tmp_path / ("a" if n % 2 else "b") / f"f{n}.txt").write_text("x" * n)
    listed = sources.list_files(spark, str(tmp_path / "a"), str(tmp_path / "b"))
    assert listed.count() == 30
    paths = [(r["path"],) for r in listed.select("path").collect()]
    refs = spark.createDataFrame([*paths, *paths, (str(tmp_path / "a" / "gone.txt"),), (str(tmp_path / "a"),), (None,)], "path string")
    found = sources.stat_files(refs)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, listed.collect()))
    assert sources.attachments(found).count() == 30
    assert sources.stat_files(refs.limit(0)).count() == 0
