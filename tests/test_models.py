import random
import time
import xml.etree.ElementTree as ET
from collections import Counter

import pytest
from pyspark.sql import functions as F

from vellumark.operators import aggregates, attachments, label_suggestions, lookups, outliers, quality, schema_docs
from vellumark.operators.inference import infer_json, infer_xsd
from vellumark.sources.documents import read_metadata_json

META = "doc_id int, version string, document_status string, retention_policies string, sensitivity_labels string, filename string"


def metadata(spark, n=400):
    rnd = random.Random(5)
    rows = [
        (i, rnd.choice("12"), rnd.choice(["final", "draft"]), "5y", rnd.choice(["a", "b", None]), f"f{i}") for i in range(n)
    ]
    rows[17] = (17, "99", "lost", "never", "odd", "f17")
    return spark.createDataFrame(rows, META)


def test_forest_finds_the_planted_document(spark):
    df = metadata(spark)
    found = outliers.forest_outliers(df, "doc_id")
    rows = found.select("doc_id", "score").collect()
    assert 17 in {r.doc_id for r in rows} and len(rows) <= 20
    assert max(rows, key=lambda r: r.score).doc_id == 17
    again = outliers.forest_outliers(df.repartition(5), "doc_id").select("doc_id", "score").collect()
    assert sorted(rows) == sorted(again)


def test_rarity_finds_the_planted_document(spark):
    rows = outliers.rarity_outliers(metadata(spark)).collect()
    assert max(rows, key=lambda r: r.score).doc_id == 17


def brute_labels(rows, k=3):
    labelled = [r for r in rows if r[1] and r[2]]
    out = {}
    for i, label, by in rows:
        if label is None and by is not None:
            near = sorted(labelled, key=lambda r: (r[2] != by, r[0]))[:k]
            votes = Counter(r[1] for r in near)
            out[i] = min(votes, key=lambda v: (-votes[v], v))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_label_suggestions(spark, seed):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice(["x", "y", "z", None]), rnd.choice(["u", "v", "w", "rare", None])) for i in range(60)]
    rows += [(60, None, "unseen"), (61, "z", "once"), (62, None, "once")]
    df = spark.createDataFrame(rows, "doc_id int, sensitivity_labels string, modifier string")
    got = {r.doc_id: r.suggestion for r in label_suggestions.suggest_labels(df, "doc_id").collect()}
    assert got == brute_labels(rows)


def test_label_suggestions_from_fewer_than_three(spark):
    none = spark.createDataFrame([(2, None, "u")], "doc_id int, sensitivity_labels string, modifier string")
    assert label_suggestions.suggest_labels(none, "doc_id").count() == 0
    df = spark.createDataFrame([(1, "x", "u"), (2, None, "u")], "doc_id int, sensitivity_labels string, modifier string")
    assert [tuple(r) for r in label_suggestions.suggest_labels(df, "doc_id").collect()] == [(2, "x")]


def test_reports_on_edges(spark):
    empty = spark.createDataFrame([], "t string, ts timestamp_ntz")
    assert aggregates.shares(empty, "t").count() == 0
    assert aggregates.duplicates(empty, ["t"]).first().asDict() == {"duplicate_files": 0, "total_occurrences": None}
    assert aggregates.completeness(empty, ["t"]).first().missing is None
    df = spark.sql(
        "SELECT * FROM VALUES ('a', timestamp_ntz'2024-01-01 12:00:00'), (null, timestamp_ntz'2023-01-01 12:00:00'), "
        "('a', timestamp_ntz'2015-01-01 00:00:00'), (null, null) AS v(t, ts)"
    )
    got = [(r.label, r["count"], r.percentage) for r in aggregates.shares(df, "t").collect()]
    assert got == [(None, 2, 50.0), ("a", 2, 50.0)]
    ages = aggregates.age_counts(df, "ts", "2024-12-31 11:59:59")
    assert [(r.age_years, r["count"]) for r in ages.collect()] == [(None, 1), (0, 1), (1, 1), (10, 1)]
    bins = aggregates.age_bins(spark, ages).collect()
    assert [(r.age_bin, r["count"]) for r in bins][:3] == [("0-1", 1), ("1-2", 1), ("2-3", 0)]
    assert aggregates.duplicates(df, ["t"]).first().total_occurrences == 4


def test_catalogue_walk(spark):
    def f(rows, schema):
        return spark.createDataFrame(rows, schema)

    paths = lookups.catalogue_paths(
        f([(7, 2), (8, 1)], "id int, ord int"),
        f([(1, 8, "app"), (2, 7, "other")], "id int, tenant_id int, name string"),
        f([(1, 2, 11), (1, 1, 10)], "application_id int, ord int, id int"),
        f([(100, 10, "S"), (101, 11, "T")], "id int, database_id int, name string"),
        f([(1, 100, "t", "/t1"), (2, 100, "t", "/t2")], "id int, schema_id int, name string, href string"),
    )
    asked = f(
        [("app", "S", "t"), ("app", "S", "u"), ("app", "T", "t"), ("other", "S", "t")],
        "application string, schema_name string, table_name string",
    )
    got = {tuple(r)[:3]: tuple(r)[3:] for r in lookups.resolve_paths(asked, paths).collect()}
    assert got == {
        ("app", "S", "t"): ("/t1", None), ("app", "S", "u"): (None, "table"), ("app", "T", "t"): (None, "schema"),
        ("other", "S", "t"): (None, "application"),
    }


def test_routes(spark):
    asked = spark.createDataFrame([("a",), ("b",), (None,)], "table_name string")
    routes = spark.createDataFrame([("a", "/a")], "table_name string, destination string")
    got = {r.table_name: (r.destination, r.error) for r in lookups.export_routes(asked, routes).collect()}
    assert got == {"a": ("/a", None), "b": (None, "unsupported table b"), None: (None, "unsupported table ")}


def test_quality(spark):
    users = spark.createDataFrame(
        [(1, "ann", "a@b.c", "admin", None), (2, "bo", "nope", "guest", 1), (3, "ann", None, "user", 9), (4, None, "x@y.z", None, 9)],
        "id int, username string, email string, role string, created_by int",
    )
    got = {r.rule: r.violations for r in quality.count_violations(users, quality.user_rules()).collect()}
    assert got == {"role_known": 1, "username_length": 1, "email_format": 1, "username_given": 1, "email_given": 1}
    broken = quality.violating_rows(users, quality.user_rules())
    assert {r.id: r.broken for r in broken.collect()}[2] == ["role_known", "username_length", "email_format"]
    assert [tuple(r) for r in quality.duplicate_keys(users, ["username"]).collect()] == [("ann", 2)]
    assert [tuple(r) for r in quality.dangling_references(users, "created_by").collect()] == [(9, 2)]


def table(spark):
    rows = [("1", "2020-01-01", "x<y", "a.txt"), ("2", "2020-01-02", 'q"', "")]
    return spark.createDataFrame(rows, "CustomerID string, day string, type string, Attachments string")


def test_metadata_json_round_trip(spark, tmp_path):
    catalogue = infer_json(table(spark), "t").unionByName(infer_json(table(spark).select("day"), "s"))
    path = str(tmp_path / "m")
    schema_docs.metadata_json(catalogue, "App", "S", "S").write.text(path)
    back = read_metadata_json(spark, path).orderBy("table_name", "ordinal").collect()
    want = catalogue.orderBy("table_name", "ordinal").collect()
    assert [(r.table_name, r.ordinal, r.name, r.type, r.type_length, r.record_count) for r in back] == [tuple(r) for r in want]


def test_json_schema_to_xsd_nested(spark):
    document = """{"type":"object","properties":{"Record":{"type":"object","properties":{
      "CustomerID":{"type":"number"},
      "outer":{"type":"object","properties":{"inner":{"type":"object","properties":{"d":{"type":"string","format":"date"}}}}},
      "many":{"type":"array","items":{"type":"string","format":"date-time"}},
      "checksum":{"type":"string","xsd_extension_attributes":{"encoding":"xs:string"}}},
      "xsd_sequence":["many","CustomerID","outer","checksum"]}}}"""
    docs = spark.createDataFrame([("t", document), ("u", '{"properties":{"Record":{"type":"object","properties":{"a":{"type":"string"}}}}}')], "table_name string, document string")
    got = {r.table_name: r.xsd for r in schema_docs.xsd_from_json_schemas(docs, "H", always_string=("CustomerID",)).collect()}
    lines = got["t"].splitlines()
    assert lines[9:12] == [
        '              <xs:element name="many" type="xs:dateTime" maxOccurs="unbounded"/>',
        '              <xs:element name="CustomerID" type="xs:string"/>',
        '              <xs:element name="outer">',
    ]
    assert '                          <xs:element name="d" type="xs:date"/>' in lines
    assert '                      <xs:attribute name="encoding" type="xs:string" use="required"/>' in lines
    rows = schema_docs.xsd_columns(spark.createDataFrame(list(got.items()), "table_name string, xsd string"))
    assert [(r.name, r.xsd_type) for r in rows.filter("table_name = 't'").orderBy("ordinal").collect()] == [
        ("many", "xs:dateTime"), ("CustomerID", "xs:string"), ("outer", "object"), ("checksum", "object"),
    ]


def test_xsd_accepts_and_rejects_records(spark, tmp_path):
    xsd = quality.write_record_xsd(spark, {"id": "xs:long", "day": "xs:date"}, str(tmp_path / "x"))
    records = spark.createDataFrame(
        [(1, "<Record><id>5</id><day>2020-01-01</day></Record>"), (2, "<Record><id>five</id><day>2020-01-01</day></Record>"),
         (3, "<Record><day>2020-01-01</day></Record>")],
        "n int, xml string",
    )
    got = quality.validate_records(records, "xml", xsd, "id string, day string")
    assert [r.valid for r in got.orderBy("n").collect()] == [True, False, False]


def test_patterns_say_what_the_validator_says(spark, tmp_path):
    kinds = {"xs:string": "s", "xs:long": "l", "xs:decimal": "x", "xs:date": "d", "xs:dateTime": "t.0"}
    usual = {"xs:string": "a", "xs:long": "5", "xs:decimal": "1.5", "xs:date": "2020-01-31", "xs:dateTime": "2020-01-31T10:00:00"}
    texts = """5|-5|+5|007|5.|.5|.|+|-|5 EUR|1e5|9223372036854775807|9223372036854775808|1 2| 5 |\t5\n|000000000000000000000005|5.50
2020-02-28|2020-02-29|2021-02-29|2020-04-31|2020-12-31|2020-13-01|2020-00-10|0999-01-01|0000-01-01|12020-01-01|-2020-01-01|2020-01-01Z
2020-01-01+13:59|2020-01-01+14:00|2020-01-01-14:01|2020-01-01T24:00:00|2020-01-01T23:59:59.123Z|2020-01-01T23:59:60|2020-01-01T23:59:59.
2020-01-01T10:00:00+02:00|2020-01-01 10:00:00|2020-01-01t10:00:00|2020-1-1|\u0663|5\xa0|a &amp; b|a & b|a &lt; b|a > b|&#53;|&quot;|]]>|<b/>|<!-- 5 -->5
<![CDATA[5]]>|  |é\U0001d4b3\U0001f642|\x0b|\x01|\x7f|\x85|\ufffe|\r|a\rb|T|Z""".replace("\n", "|").split("|")
    texts = [t.encode("latin-1", "backslashreplace").decode("unicode_escape") for t in texts] + [""]

    def record(changed, text):
        fields = {f: usual[k] for k, f in kinds.items()} | {kinds[changed]: text}
        return "<Record>" + "".join(f"<{f}>{t}</{f}>" for f, t in fields.items()) + "</Record>"

    rows = [record(k, t) for k in kinds for t in texts]
    good = record("xs:string", "a")
    rows += [good.replace("<l>5</l>", e) for e in ("<l/>", "<l />", "<l  />", "", "<l a='1'>5</l>", "<l>5</l> ", "<l>5</l><l>5</l>", "<L>5</L>")]
    rows += [good.replace("<s>a</s>", e) for e in ("<s/>", "<s />", "<s></s>", "<s>a</x>", "text", "<t0>a</t0>")]
    rows += [good + "\n", " " + good, good + good, '<?xml version="1.0"?>' + good, good.replace("t.0>", "t00>"), good.replace("Record", "Row"), "", None]
    df = spark.createDataFrame(list(enumerate(rows)), "n int, xml string").repartition(4)
    xsd = quality.write_record_xsd(spark, {f: k for k, f in kinds.items()}, str(tmp_path / "x"))
    schema = "s string, l string, x string, d string, `t.0` string"
    options = {"rowValidationXSDPath": xsd, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    parsed = F.from_xml("xml", f"{schema}, _corrupt string", options)["_corrupt"].isNull()
    want = {r.n: r.valid for r in df.select("n", parsed.alias("valid")).collect()}
    got = {r.n: r.valid for r in quality.validate_records(df, "xml", xsd, schema).collect()}
    assert [(rows[n], got[n]) for n in want if got[n] != want[n]] == []
    assert 50 < sum(want.values()) < len(rows) - 50


def test_plain_records_need_no_validator(spark, tmp_path):
    xsd = quality.write_record_xsd(spark, {"id": "xs:long", "price": "xs:decimal"}, str(tmp_path / "x"))
    price = F.concat(F.col("id").cast("string"), F.when(F.col("id") % 2 == 1, ".5").otherwise(" EUR"))
    xml = F.concat(F.lit("<Record><id>"), F.col("id").cast("string"), F.lit("</id><price>"), price, F.lit("</price></Record>"))
    checked = quality.validate_records(spark.range(100_000).withColumn("xml", xml), "xml", xsd, "id string, price string")
    begin = time.monotonic()
    assert checked.where("valid").count() == 50_000
    quick = time.monotonic() - begin
    mended = spark.range(100_000).withColumn("xml", F.concat(F.lit(" "), xml))  # not plain
    begin = time.monotonic()
    assert quality.validate_records(mended, "xml", xsd, "id string, price string").where("valid").count() == 50_000
    assert quick * 2 < time.monotonic() - begin


def test_payloads_fit_their_xsd(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, "high", "a & b", "x"), (2, None, "", "y")], "n int, `order priority` string, type string, plain string"
    )
    columns = ["order priority", "type", "plain"]
    files = spark.createDataFrame([], "n int, slot int, name string, mimetype string, size long, checksum string")
    xml = attachments.record_fragments(df, "n", columns, files, "/in")
    parsed = [[e.tag for e in ET.fromstring(r.xml)] for r in xml.collect()]
    assert parsed == [["order_priority", "type_field", "plain", "Attachments"]] * 2
    types = {c: "xs:string" for c in parsed[0][:3]}
    xsd = quality.write_record_xsd(spark, types, str(tmp_path / "x"))
    bare = xml.withColumn("xml", F.replace("xml", F.lit("<Attachments />"), F.lit("")))
    schema = ", ".join(f"{c} string" for c in types)
    assert all(r.valid for r in quality.validate_records(bare, "xml", xsd, schema).collect())
    listed = spark.createDataFrame(
        [("t", i, c, "xs:string") for i, c in enumerate(parsed[0][:3])], "table_name string, ordinal int, name string, type string"
    )
    spaced = listed.withColumn("name", F.replace("name", F.lit("_p"), F.lit(" p")))
    made = schema_docs.xsd_from_catalogue(spaced, "Cards").first().xsd
    names = [e.get("name") for e in ET.fromstring(made.encode()).iter() if e.get("type") == "xs:string"]
    assert names == parsed[0][:3]


def test_xsd_from_types(spark):
    xsd = schema_docs.xsd_from_catalogue(infer_xsd(table(spark), "t"), "Cards").first().xsd
    assert '<xs:element name="type_field" type="xs:string"/>' in xsd and xsd.count('name="Attachments"') == 1
    assert 'targetNamespace="urn:eas-samples:en:xsd:cards.1.0"' in xsd
