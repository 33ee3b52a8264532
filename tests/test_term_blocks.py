import math
import random

from pyspark.sql import functions as F

from vellumark.operators import enrichment, term_blocks, topics


def documents(n=40):
    draw = random.Random(5)
    letters = "abcdefghij"
    return {i: [draw.choice(letters) * draw.randint(1, 3) for _ in range(draw.randint(0, 30))] for i in range(n)}


def test_blocks_hold_every_count(spark, monkeypatch):
    """Blocks of few words: a row's parts stay together, empty and null rows have no terms."""
    texts = documents()
    rows = [(i, [w[:9], w[9:]]) for i, w in texts.items()] + [(100, None), (101, [[], []])]
    df = spark.createDataFrame(rows, "k int, words array<array<string>>").repartition(3)
    terms, blocks = term_blocks.term_blocks(df, "words", ["k"])
    got = {r.term: (r.df, r.n) for r in terms.groupBy("term").agg(F.sum("rows").alias("df"), F.sum("n").alias("n")).collect()}
    every = {w for t in texts.values() for w in t}
    assert got == {w: (sum(w in t for t in texts.values()), sum(t.count(w) for t in texts.values())) for w in every}
    assert blocks.agg(F.sum("counted_rows")).first()[0] == sum(bool(t) for t in texts.values())


def test_topic_rounds_equal_plain_ones(spark):
    """The rounds block by block against the same sums over all (text, term) at once."""
    k, rounds = 3, 4
    texts = {i: t for i, t in documents().items() if t}
    df = spark.createDataFrame(list(texts.items()), "_row long, words array<string>").repartition(4)
    of_rows, terms = topics.topic_model(df, "words", k, rounds)
    names = sorted({w for t in texts.values() for w in t})
    draws = spark.createDataFrame([(w,) for w in names], "term string").select(
        "term", *[(F.pmod(F.xxhash64("term", F.lit(42), F.lit(i)), F.lit(1 << 20)) + 1).alias(f"d{i}") for i in range(k)]
    )
    weights = {r[0]: [sum(t.count(r[0]) for t in texts.values()) * d / sum(r[1:]) for d in r[1:]] for r in draws.collect()}
    has = None
    for _ in range(rounds):
        totals = [sum(w[i] for w in weights.values()) + 0.1 * len(weights) for i in range(k)]
        new, new_has = {w: [0.0] * k for w in names}, {d: [0.0] * k for d in texts}
        for d, t in texts.items():
            for w in set(t):
                p = [(weights[w][i] + 0.1) / totals[i] * (1 if has is None else has[d][i] + 0.1) for i in range(k)]
                for i in range(k):
                    new[w][i] += t.count(w) * p[i] / sum(p)
                    new_has[d][i] += t.count(w) * p[i] / sum(p)
        weights, has = new, new_has
    got = {r.term: r.weights for r in terms.collect()}
    assert got.keys() == weights.keys()
    assert all(math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9) for w in names for a, b in zip(got[w], weights[w], strict=True))
    assert {r._row: r.topic for r in of_rows.collect()} == {d: max(range(k), key=lambda i: (h[i], -i)) for d, h in has.items()}


def test_a_round_shuffles_terms_by_block(spark):
    """One text a hundred times: each term goes to a block once, not a hundred times."""
    df = spark.createDataFrame([(i, ["x", "y", "z"]) for i in range(100)], "_row long, words array<string>").coalesce(1)
    terms, blocks = term_blocks.term_blocks(df, "words", ["_row"])
    assert terms.count() == 3 and blocks.count() == 1


def test_keywords_of_many_equal_scores(spark):
    """Candidates hold every term that may be chosen: equal scores go by term, rows of one key are ranked together."""
    words = ["".join(random.Random(i).choices("abcdefgh", k=6)) for i in range(60)]
    rows = [(1, " ".join(words[:40])), (1, " ".join(words[20:])), (2, " ".join(words[:5] * 2)), (3, None), (None, words[0])]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    scored = {}
    texts = [t.split() for _, t in rows if t]
    for k, t in rows:
        for w in set((t or "").split()):
            idf = math.log(len(texts) / sum(w in x for x in texts))
            scored.setdefault(k, []).append((-round(t.split().count(w) * idf, 6), w))
    wanted = {(k, r, w, -s) for k, x in scored.items() for r, (s, w) in enumerate(sorted(x)[:10], 1)}
    got = [tuple(r) for r in enrichment.keywords(df).collect()]
    assert {(k, r, w, round(s, 6)) for k, r, w, s in got} == wanted


def test_deliveries_are_sent_in_bounded_batches(spark, tmp_path):
    from vellumark.sinks import ledger

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(1 << 30))
    try:
        docs = spark.range(6).select(F.col("id").alias("chunk_id"), F.lit(1).cast("bigint").alias("rows"), F.lit(1).cast("bigint").alias("bytes"), F.col("id").cast("string").alias("sha"), F.repeat(F.lit("x"), 3 << 20).alias("payload"))
        out = ledger.deliver(docs.coalesce(1), str(tmp_path / "ledger"), lambda payload, attempt: 201)
        assert out.count() == 6 and spark.conf.get(key) == "4m"
    finally:
        spark.conf.set(key, before)


def test_staged_texts_lie_in_several_folders(spark, tmp_path):
    from vellumark.sources import files

    df = spark.range(200).select(F.concat(F.lit("f"), F.col("id") % 100, F.lit(".txt")).alias("name"), F.lit("x").alias("text"))
    folders = files.write_spread_texts(df.repartition(5), str(tmp_path / "many"), 9)
    assert 1 < len(folders) <= 9
    assert sorted(r["name"] for r in files.list_files(spark, *folders).collect()) == sorted(f"f{i}.txt" for i in range(100))
    assert [r["name"] for r in files.read_text_heads(spark, folders, 2).collect()] == ["f0.txt", "f1.txt"]
