import math
import random
import re
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from vellumark.functions import values
from vellumark.operators import enrichment, text_chunks, vectors
from vellumark.operators.label_suggestions import suggest_labels

cloudpickle.register_pickle_by_value(sys.modules[__name__])

HEADING = r"(?:^|\n)(?:#+\s|[A-Z][A-Z\s]+:|\d+\.\s)"


def want(text, strategy):
    def runs(parts, n):
        return [" ".join(parts[i : i + n]) for i in range(0, len(parts), n)]

    if strategy == "fixed":
        return runs(text.split(), 500)
    if strategy == "sentence":
        return runs(re.split(r"(?<=[.!?])\s+(?=[A-Z])", text.strip()), 5)
    pieces = re.split(HEADING, text)
    if strategy == "heading":
        return [p.strip() for p in pieces if p.strip()]
    if strategy == "hybrid":
        out = []
        for p in pieces:
            out += runs(p.split(), 500) if len(p.split()) > 500 else [p.strip()] if p.strip() else []
        return out
    return [p.strip() for p in text.split("\n\n") if p.strip()]


TEXTS = [
    "",
    "   \n ",
    "One. Two! three? Four five.\tSix. É seven. " * 9,
    "# Title\nbody text\n\nINTRO PART: more\n1. item\n12. item\n\n\n\nend",
    " ".join(f"w{i}" for i in range(1203)),
    "## A\n" + " ".join(f"x{i}" for i in range(700)) + "\n# B\nshort one",
    "　wide space line\n\n \n\nlast",
]


@pytest.mark.parametrize("strategy", ["fixed", "sentence", "heading", "hybrid", "paragraph", "other"])
def test_chunks(spark, strategy):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, text string")
    got = {}
    for r in text_chunks.chunks(df, strategy).orderBy("doc_id", "chunk_no").collect():
        got.setdefault(r.doc_id, []).append(r.text)
    assert got == {i: c for i, t in enumerate(TEXTS) if (c := want(t, strategy))}


def test_semantic_chunks_keep_all_paragraphs(spark):
    rnd = random.Random(1)
    themes = ["ship sea harbour sail", "bread oven flour yeast", "code bug test compile"]
    texts = [
        "\n\n".join(" ".join(rnd.choices(themes[rnd.randrange(3)].split(), k=20)) for _ in range(k)) for k in (1, 2, 8)
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    rows = text_chunks.chunks(df, "semantic").collect()
    for i, t in enumerate(texts):
        chunks = [r.text for r in sorted((r for r in rows if r.doc_id == i), key=lambda r: r.chunk_no)]
        assert sorted("\n\n".join(chunks).split("\n\n")) == sorted(t.split("\n\n"))
        assert 1 <= len(chunks) <= 3
        assert chunks[0].split("\n\n")[0] == t.split("\n\n")[0]


def test_embedding(spark):
    df = spark.createDataFrame([(1, "red apple"), (2, "red apple"), (3, "blue sky over town"), (4, "")], "n int, text string")
    got = {r.n: r.vector for r in vectors.embed(df, dimensions=64).collect()}
    assert {len(v) for v in got.values()} == {64}
    assert got[1] == got[2] != got[3]
    assert math.isclose(sum(x * x for x in got[1]), 1, rel_tol=1e-5) and not any(got[4])


def test_model_must_give_vectors(spark):
    df = spark.createDataFrame([("a",), ("",)], "text string")
    good = vectors.embed_with(df, lambda texts: [[float(len(t)), 1.0] for t in texts])
    assert sorted(r.vector for r in good.collect()) == [[0.0, 1.0], [1.0, 1.0]]
    with pytest.raises(Exception, match="no vector"):
        vectors.embed_with(df, lambda texts: [[1.0] if t else [] for t in texts]).collect()


def test_cosine_search_is_exact(spark):
    rnd = random.Random(3)
    pts = [(i, [rnd.choice([-1.0, 0.0, 1.0, 0.5]) for _ in range(6)]) for i in range(300)]
    queries = [(100 + i, [rnd.uniform(-1, 1) for _ in range(6)]) for i in range(5)]
    p = spark.createDataFrame(pts, "id int, vector array<float>").repartition(4)
    q = spark.createDataFrame(queries, "query_id int, vector array<float>")

    def cos(a, b):
        na, nb = math.hypot(*a), math.hypot(*b)
        return round(sum(x * y for x, y in zip(a, b)) / (na * nb), 6) if na and nb else 0.0

    for block in (2, 1024):
        got = vectors.cosine_topk(p, q, 7, block=block).orderBy("query_id", "rank").collect()
        for qid, qv in queries:
            near = sorted((-cos([float(x) for x in v], qv), i) for i, v in pts)[:7]
            mine = [(r.id, r.similarity) for r in got if r.query_id == qid]
            assert [abs(s + n) < 2e-6 for (_, s), (n, _) in zip(mine, near)] == [True] * 7
            assert sorted(i for i, _ in mine) == sorted(i for _, i in near)


def test_quantization_error_is_half_a_step(spark):
    df = spark.createDataFrame([(1, [0.0, 1.0]), (2, [-1.0, 0.3])], "id int, vector array<float>")
    for r in vectors.quantize_int8(df).collect():
        assert r.max_error <= 1 / 255 + 1e-9 and all(-128 <= c <= 127 for c in r.code)
    flat = spark.createDataFrame([(1, [2.0, 2.0])], "id int, vector array<float>")
    assert vectors.quantize_int8(flat).first().code == [-128, -128]


def test_points_are_idempotent(spark, tmp_path):
    df = spark.createDataFrame([(0, [1.0], "t", "f"), (1, [2.0], "u", "f")], "n int, vector array<float>, text string, src string")
    pts = vectors.points(df, "src", "n")
    where = str(tmp_path)
    vectors.upsert_points(pts, where, "v1")
    assert vectors.upsert_points(pts, where, "v2", "v1").count() == 2
    changed = vectors.points(df.withColumn("text", F.concat("text", F.lit("!"))), "src", "n")
    assert vectors.upsert_points(changed, where, "v3", "v2").count() == 4


def test_personal_data(spark):
    text = "mail a.b@c.example.org, call +1 (555) 123-4567, 10.0.0.1; 4111111111111111 4111111111111112 123-45-6789"
    got = {(r.kind, r.value) for r in enrichment.personal_data(spark.createDataFrame([(1, text)], "doc_id int, text string")).collect()}
    assert got == {
        ("email", "a.b@c.example.org"), ("phone", "+1 (555) 123-4567"), ("ipv4", "10.0.0.1"),
        ("card", "4111111111111111"), ("national_id", "123-45-6789"),
    }


def test_personal_data_layouts(spark):
    found = {
        "call 555-123-4567 or (555) 123-4567.": {("phone", "555-123-4567"), ("phone", "(555) 123-4567")},
        "Berlin +49 30 1234567, Paris +33 1 23 45 67 89": {("phone", "+49 30 1234567"), ("phone", "+33 1 23 45 67 89")},
        "host 192.168.1.254 but not 999.999.999.999 or 1.2.3.4567": {("ipv4", "192.168.1.254")},
        "4111-1111-1111-1111 x4111111111111111x": {("card", "4111-1111-1111-1111")},
        "order 0123-45-67890 of 2020-01-02": set(),
        "IBAN DE89370400440532013000, GB29 NWBK 6016 1331 9268 19": {
            ("iban", "DE89370400440532013000"), ("iban", "GB29 NWBK 6016 1331 9268 19"),
        },
        "": set(),
    }
    df = spark.createDataFrame([(t, t) for t in found], "doc_id string, text string")
    got = {t: set() for t in found}
    for r in enrichment.personal_data(df).collect():
        got[r.doc_id].add((r.kind, r.value))
    assert got == found


def test_entities_of_several_words(spark):
    text = "Anna Bell of Bell Trading Company flew from New York to York, then St. Louis. New\nYork; NewYork, New, York."
    df = spark.createDataFrame([(1, text), (2, ""), (3, None)], "doc_id int, text string")
    listed = spark.createDataFrame([("New York",), ("York",), ("York",), ("St. Louis",), (None,), ("",)], "name string")
    got = {(r.doc_id, r.kind, r.value): r.occurrences for r in enrichment.entities(df, listed).collect()}
    assert {k[1:]: n for k, n in got.items() if k[1] == "place"} == {
        ("place", "New York"): 2, ("place", "York"): 4, ("place", "St. Louis"): 1,
    }
    assert got[(1, "person", "Anna Bell")] == 1 and got[(1, "organisation", "Bell Trading Company")] == 1
    assert {k[0] for k in got} == {1}
    assert enrichment.entities(df, listed.limit(0)).filter("kind = 'place'").count() == 0


def test_alternates_of_asked_terms(spark):
    texts = ["the big dog ran", "the large dog ran", "the huge dog ran"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    asked = spark.createDataFrame([("big",), ("big",), ("none",)], "term string")
    every = enrichment.alternates(df).filter("term = 'big'").collect()
    assert len(every) == 2 and sorted(enrichment.alternates(df, asked=asked).collect()) == sorted(every)


def test_intent_keywords_summary(spark):
    docs = [(1, "Please use this. You must run it. Nothing else."), (2, "xyz."), (3, "The report shows a total result.")]
    df = spark.createDataFrame(docs, "doc_id int, text string")
    assert {r.doc_id: r.intent for r in enrichment.intents(df).collect()} == {
        1: "instruction", 2: "unknown", 3: "report",
    }
    assert [r.term for r in enrichment.keywords(df).filter("doc_id = 2").collect()] == ["xyz"]
    short = {r.doc_id: r.summary for r in enrichment.summaries(df, top=2).collect()}
    assert short[1] == "Please use this. You must run it."


def test_synonyms_share_places(spark):
    texts = ["the big dog ran", "the large dog ran", "the big dog ran", "a cat sat"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {(r.term, r.alternate): r.score for r in enrichment.alternates(df).collect()}
    assert got == {("big", "large"): 1, ("large", "big"): 1}


def test_topics_cover_all_documents(spark):
    rnd = random.Random(2)
    themes = ["ship sea harbour sail", "bread oven flour yeast"]
    df = spark.createDataFrame(
        [(i, " ".join(rnd.choices(themes[i % 2].split(), k=30))) for i in range(20)], "doc_id int, text string"
    )
    rows = enrichment.topics(df, k=2).collect()
    assert len(rows) == 20 and all(0 <= r.topic < 2 and len(r.label.split()) == 3 for r in rows)


def test_scalars(spark):
    df = spark.createDataFrame(
        [(" a ; b;;", "2025-07-09 12:30:11.5+00"), ("x|y", "2025-07-09 12:30:11+00"), ("", "soon"), (None, None)],
        "cell string, ts string",
    )
    rows = df.select(values.split_paths(F.col("cell")).alias("p"), values.parse_run_timestamp(F.col("ts")).alias("t")).collect()
    assert [r.p for r in rows] == [["a", "b"], ["x", "y"], [], []]
    assert [r.t is not None for r in rows] == [True, True, False, False]
    text = spark.createDataFrame([("<think>a\nb</think> x <think></think>y",)], "t string")
    assert text.select(values.strip_think(F.col("t")).alias("t")).first().t == "x y"


def test_texts_without_terms(spark):
    df = spark.createDataFrame([(1, "the and\n\nof"), (2, "")], "doc_id int, text string")
    assert [(r.topic, r.label) for r in enrichment.topics(df).collect()] == [(None, "")] * 2
    assert [(r.doc_id, r.text) for r in text_chunks.chunks(df, "semantic").collect()] == [(1, "the and\n\nof")]
    unshared = spark.createDataFrame([(1, "alpha"), (2, "beta")], "doc_id int, text string")
    assert enrichment.topics(unshared).filter("topic IS NULL").count() == 0  # all terms count, unshared ones too
    assert enrichment.keywords(df.filter("doc_id = 2")).count() == 0


def test_null_texts_and_texts_without_terms(spark):
    rows = [(0, None), (1, ""), (2, "12 34"), (3, "please run the ship to the harbour"), (4, "flour and yeast in the oven"), (5, "lonely")]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    topics = {r.doc_id: (r.topic, r.label) for r in enrichment.topics(df, k=2).collect()}
    assert [topics[i] for i in range(3)] == [(None, "")] * 3
    assert all(topics[i][0] in (0, 1) and topics[i][1] for i in (3, 4, 5))  # a single unshared word counts, too
    intents = {r.doc_id: (r.intent, r.score) for r in enrichment.intents(df).collect()}
    assert intents[0] == intents[1] == ("unknown", 0) and intents[3] == ("instruction", 2)
    embedded = {r.doc_id: r.vector for r in vectors.embed(df).collect()}
    assert set(embedded[0]) == set(embedded[1]) == {0.0} and any(embedded[3])
    assert vectors.embed(df).columns == ["doc_id", "text", "vector"]


def test_suggestions_from_few_labels(spark):
    rows = [(1, "a", "public"), (2, "b", "internal"), (3, "a", None), (4, "c", None)]
    df = spark.createDataFrame(rows, "doc_id int, modifier string, sensitivity_labels string")
    assert sorted(map(tuple, suggest_labels(df, "doc_id").collect())) == [(3, "internal"), (4, "internal")]


def test_every_usual_term_of_a_place_counts(spark):
    """Eight equally frequent terms of one place are all alternates of each other; in a place where anything fits, none is."""
    eight = [f"the {c * 3} dog ran" for c in "abcdefgh"]
    many = [f"of {a}{b}x him" for a in "abcdefgh" for b in "abcdefgh"]
    df = spark.createDataFrame(list(enumerate([*eight, *many])), "doc_id int, text string")
    for parts in (1, 4):
        found = enrichment.alternates(df.repartition(parts), top=100).collect()
        assert len(found) == 8 * 7 and {r.score for r in found} == {1}


def test_a_rare_term_meets_the_one_usual_term(spark):
    texts = ["a big dog"] * 20 + ["a huge dog"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    assert [tuple(r) for r in enrichment.alternates(df).collect()] == [("huge", 1, "big", 1)]
