"""The operators of the llm subpackage against brute force, on small fixtures with nulls, ties and repeated rows."""

import hashlib
import re
import zlib
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from vellumark.llm import chunked_bpe, components, extraction, fingerprints, jaccard, learning, packing, quality, rans, rules, scan, substrings, tokens, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = ["", "  \n ", "a", "It's DON'T <|endoftext|> x<|EndOfText|>", "İ É é ﬁ 12 x\x0by", "w " * 4000, "é" * 3000, "one two three four five six"]
SCHEMA = "doc_id bigint, text string, spans string, n_chars bigint"


def prose(seed, n):
    draw = np.random.default_rng(seed)
    return " ".join("".join(draw.choice(list("abcdefgh"), draw.integers(4, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    base = [prose(k, 120) for k in range(6)]
    near = base[0].split()
    near[60] = "changed"
    texts = [*ODD, None, *base, base[0], " ".join(near), "x " + prose(50, 30) + " " + prose(99, 60), prose(51, 40) + " " + prose(99, 60) + " end"]
    return [(k, t, "clash", len(t or "")) for k, t in enumerate(texts)] + [(None, base[1], None, 1), (3, texts[3], None, 2)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def library():
    return tokens.encoder(tokens.tokenizer_path()).library


def test_word_and_chunk_encoding(rows, library):
    texts = [t or "" for _, t, _, _ in rows]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for coder in (tokens.encoder(tokens.tokenizer_path()), chunked_bpe.chunk_encoder(tokens.tokenizer_path())):
        for _ in range(2):
            ids, bounds = coder.encode(pa.array(texts))
            assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == want
    decoded = coder.decode(ids, bounds).to_pylist()
    assert decoded == library.decode_batch(want, skip_special_tokens=False)


def test_bpe_query(docs, empty, rows, library):
    made = sorted(chunked_bpe.round_trip_digests(docs).collect(), key=str)
    want = []
    for k, t, _, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((k, len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), text))))
    assert sorted(map(tuple, made), key=str) == sorted(want, key=str)
    assert chunked_bpe.round_trip_digests(empty).count() == 0
    ids = chunked_bpe.encode_documents(docs)
    assert chunked_bpe.decode_documents(ids).count() == len(rows)


def test_packing(docs, empty, rows, library):
    made = packing.pack_documents(docs, capacity=64, shard_pieces=10).toPandas()
    want = []
    for k, t, _, _ in rows:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        want += [(k, at // 64, at, len(p := ids[at : at + 64]), zlib.crc32(p.tobytes())) for at in range(0, len(ids), 64)]
    got = [(None if np.isnan(r[0]) else int(r[0]), *map(int, r[1:5])) for r in made.itertuples(index=False)]
    assert sorted(got, key=str) == sorted(want, key=str)
    for _, own in made.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert own["offset"].tolist() == [0, *own["length"].cumsum().tolist()[:-1]] and own["length"].sum() <= 64
    assert packing.pack_documents(empty).count() == 0


def test_sum_of_squares_is_near_the_bound():
    lengths = np.random.default_rng(1).integers(1, 600, 4000)
    sequence, _ = packing.place_all(lengths)
    assert sequence.max() + 1 <= 1.01 * lengths.sum() / packing.CAPACITY + 1


def test_token_files(docs, empty, rows, library):
    manifest = rans.write_token_files(docs, file_ids=500)
    assert manifest.count() >= 1
    got = rans.read_token_files(manifest).orderBy("start").collect()
    digests = {r["start"]: r["ids_crc32"] for r in rans.read_token_digests(manifest).collect()}
    start = 0
    for (k, t, _, _), r in zip(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")), got, strict=True):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids"]) == (k, start, len(ids), ids)
        assert digests[start] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert rans.read_token_files(rans.write_token_files(empty)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 5000, 140_000])
def test_rans_round_trip_and_damage(n):
    ids = (np.random.default_rng(n).zipf(1.4, n) % 40_000).astype(np.uint32)
    data = rans.file_bytes([7, None], np.array([n, 0]), ids)
    doc_ids, lengths, back = rans.read_file(data)
    assert doc_ids == [7, None] and lengths.tolist() == [n, 0] and np.array_equal(back, ids)
    if n:
        with pytest.raises(ValueError):
            rans.read_file(data[:-1] + bytes([data[-1] ^ 1]))


def shingle_set(text, size, lower=True):
    text = (text or "").translate({c: c + 32 for c in range(65, 91)}) if lower else text or ""
    w = WORD.findall(text)
    return {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def smallest_reachable(sets, percent):
    """The function that finds a document's component, from all pairs of (doc_id, set)."""
    root = {k: k for k, _ in sets if k is not None}

    def find(k):
        return k if root[k] == k else find(root[k])

    for (a, x), (b, y) in combinations(sets, 2):
        if a is not None and b is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return find


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80)])
def test_jaccard(docs, empty, rows, size, percent):
    sets = [(k, shingle_set(t, size)) for k, t, _, _ in rows]
    find = smallest_reachable(sets, percent)
    made = jaccard.link_documents(docs, size, percent).collect()
    assert len(made) == len(rows)
    for r in made:
        if r["doc_id"] is not None:
            assert r["component_id"] == find(r["doc_id"])
            assert r["n_shingles"] == len(dict(sets)[r["doc_id"]])
    assert jaccard.link_documents(empty, size, percent).count() == 0


@pytest.mark.parametrize("words", [90, 1500])
def test_jaccard_of_a_group_about_the_bound(spark, words):
    draw = np.random.default_rng(words)
    base, rows = prose(7, words).split(), []
    for k in range(70):  # likenesses to either side of 0.9, in buckets of more than FEW_SETS sets
        text = list(base)
        for at in draw.choice(words, int(words * draw.uniform(0, 0.04)), replace=False):
            text[at] = f"new{k}x{at}"
        rows.append((k * 3, " ".join(text)))
    find = smallest_reachable([(k, shingle_set(t, 3)) for k, t in rows], 90)
    made = jaccard.link_documents(spark.createDataFrame(rows, "doc_id bigint, text string"), 3, 90).collect()
    assert {r["doc_id"]: r["component_id"] for r in made} == {k: find(k) for k, _ in rows}
    assert len({find(k) for k, _ in rows}) > jaccard.FEW_SETS


def test_sketches_never_differ_more_than_sets():
    draw = np.random.default_rng(3)
    a = np.unique(draw.integers(0, 2**63, 900, dtype=np.uint64))
    b = np.unique(np.concatenate([a[:800], draw.integers(0, 2**63, 70, dtype=np.uint64)]))
    made = jaccard._sketches(np.concatenate([a, b, a]), np.cumsum([0, len(a), len(b), len(a)]))
    longs = np.array([column.to_numpy() for column in made])
    differ = [sum(int(x).bit_count() for x in (longs[:, 0] ^ longs[:, k]).view(np.uint64)) for k in (1, 2)]
    apart = len(np.setxor1d(a, b))
    assert differ[1] == 0 and 0 < differ[0] <= apart and (apart - differ[0]) % 2 == 0


def test_one_of_each_group(docs, rows):
    kept = jaccard.one_of_each_group(docs)
    ids = [r["doc_id"] for r in kept.collect()]
    assert kept.columns == docs.columns and ids.count(3) == 1 and 15 not in ids and 16 not in ids and None in ids


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(500, 501), (501, 501)], "a bigint, b bigint")
    made = dict(map(tuple, components.components(links).collect()))
    assert made == {**{k: 0 for k in range(201)}, 500: 500, 501: 500}


def test_substrings(docs, empty, rows):
    made = {r["doc_id"]: r for r in substrings.dedup(docs).where("doc_id is not null").collect()}
    texts = {k: t for k, t, _, _ in rows}
    assert made[15]["removed_words"] > 80  # an exact copy
    assert made[18]["removed_words"] >= 24 and made[17]["text"] == texts[17]
    assert prose(51, 40) in made[18]["text"] and prose(99, 60) not in made[18]["text"]
    assert all(made[k]["text"] == texts[k] for k in range(15))
    assert substrings.dedup(empty).count() == 0


def test_runs_follow_the_content():
    text = prose(3, 400)
    digests = [set(substrings.runs(pa.array([t]))[1].tolist()) for t in (text, "an insertion of words " + text)]
    assert len(digests[0] & digests[1]) > 0.9 * len(digests[0])


def fingerprint_by_hand(text):
    def signed(x):
        return x - (1 << 64) if x >> 63 else x

    w = [x for x in WORD.findall(text or "")]
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in w]
    size = fingerprints.SHINGLE_WORDS

    def chain(values):
        seed = 42
        for v in values:
            seed = xxhash.xxh64_intdigest(int(v).to_bytes(8, "little"), seed)
        return seed

    made = [chain(hashes[k : k + size]) for k in range(len(w) - size + 1)] if len(w) >= size else [xxhash.xxh64_intdigest(" ".join(w).encode(), 42)] if w else []
    if not made:
        return "0" * fingerprints.BINS
    bins = {}
    for h in map(signed, made):
        b = (h >> 56) + 128
        bins[b] = min(bins.get(b, 1 << 70), h)
    stops, ranks = fingerprints._tours()
    out = []
    for b in range(fingerprints.BINS):
        best = b if b in bins else min(bins, key=lambda j: ranks[b][j])
        out.append("0123456789abcdef"[chain([bins[best] % (1 << 64), b]) & 15])
    return "".join(out)


def test_fingerprints(docs, empty, rows):
    made = fingerprints.fingerprint_edits(docs.where("doc_id is not null").dropDuplicates(["doc_id"])).collect()
    texts = {k: t or "" for k, t, _, _ in rows if k is not None}
    order = sorted(texts, reverse=True)
    assert sorted(r["doc_id"] for r in made) == sorted(texts)
    for r in made:
        k = r["doc_id"]
        after = texts[order[(order.index(k) + 1) % len(order)]]
        half = len(texts[k]) // 2
        edited = texts[k][: len(texts[k]) - half] + after[:half]
        assert r["n_chars"] == len(texts[k]) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert (r["fingerprint"], r["edited_fingerprint"]) == (fingerprint_by_hand(texts[k]), fingerprint_by_hand(edited))
        x, y = shingle_set(texts[k], 5, False), shingle_set(edited, 5, False)
        assert abs(r["near_edited"] - (len(x & y) / len(x | y) if x | y else 1.0)) < 0.2
    assert fingerprints.fingerprint_edits(empty).count() == 0
    assert fingerprints.fingerprint_edits(docs).count() == len(rows)


def test_rule_statistics(rows):
    texts = [t or "" for _, t, _, _ in rows] + ["a b c a b c d", "x\ny z\nx\n\n \nx", "###é A|B"]
    made = rules.statistics(pa.array(texts))
    for k, t in enumerate(texts):
        w = WORD.findall(t)
        win = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        hit = {i + j for i, x in enumerate(win) if win.count(x) > 1 for j in range(3)} if len(win) < 500 else None
        lines = [x for x in t.split("\n") if WORD.search(x)]
        assert made["n_words"][k] == len(w) and made["word_chars"][k] == sum(map(len, w)) and made["n_chars"][k] == len(t)
        assert made["n_symbols"][k] == len(re.findall(r"[#*$%&|<>]", t)) and made["n_dup_lines"][k] == len(lines) - len(set(lines))
        assert hit is None or made["n_repeat_words"][k] == len(hit)


@pytest.fixture(scope="module")
def labelled(spark):
    draw = np.random.default_rng(4)
    docs, labels = [], []
    for k in range(400):
        good, toxic = k % 4 > 0, k % 5 == 0
        w = prose(1000 + k, 80).split()
        w = w if good else [x + "***" for x in w]
        for _ in range(4 if toxic else 0):
            w.insert(int(draw.integers(0, len(w))), str(draw.choice(["vile", "nasty", "foul"])))
        docs.append((k, " ".join(w)))
        labels.append((k, int(good), int(toxic)))
    docs += [(1000, None), (1001, ""), (None, "x y")]
    labels += [(0, None, None), (None, 1, 1), (1, 1, 0)]
    return spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


@pytest.mark.parametrize(("module", "column", "modulus", "out"), [(quality, "quality", 4, 2), (toxicity, "toxic", 3, 1)])
def test_classifiers(labelled, empty, module, column, modulus, out):
    docs, labels = labelled
    made = module.classify(docs, labels).collect()
    truth = {r["doc_id"]: r[column] for r in labels.collect() if r[column] is not None}
    assert len(made) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in made)
    held = [r for r in made if r["held_out"]]
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % modulus == out) for r in made)
    right = [r["predicted"] == truth[r["doc_id"]] for r in held if r["doc_id"] in truth]
    assert len(right) > 50 and np.mean(right) > 0.9
    assert module.classify(docs, labels.limit(0)).where("predicted = 1").count() == 0
    assert module.classify(empty, labels).count() == 0


def test_block_max_index_is_exact():
    draw = np.random.default_rng(9)
    n, terms = 500, 60
    dense = draw.random((n, terms)) * (draw.random((n, terms)) < 0.1)
    dense /= np.maximum(np.linalg.norm(dense, axis=1, keepdims=True), 1e-9)
    example, term = np.nonzero(dense)
    index = toxicity.BlockMaxIndex(term, example, dense[example, term], terms, n)
    for _ in range(30):
        t = np.sort(draw.choice(terms, 6, replace=False))
        q = draw.random(6)
        q /= np.linalg.norm(q)
        ((near, cosine),) = index.nearest([(t, q)], 10)
        every = np.round(dense[:, t] @ q, 12)
        want = [i for i in np.lexsort((np.arange(n), -every)) if every[i] > 0][:10]
        assert near.tolist() == want and np.allclose(cosine, every[want])


def test_rules(labelled, empty):
    docs, labels = labelled
    made = {r["doc_id"]: r for r in rules.apply_rules(docs, labels).collect()}
    assert len(made) == docs.count()
    truth = {r["doc_id"]: r["quality"] for r in labels.collect() if r["quality"] is not None and r["doc_id"] is not None}
    assert np.mean([made[k]["kept"] == bool(v) for k, v in truth.items()]) > 0.9
    assert made[1000]["base_failed"] and not made[1001]["kept"]
    assert rules.apply_rules(empty, labels).count() == 0


def test_extraction(spark):
    main = "".join(f"<p>{prose(k, 40)} &amp; more.</p>" for k in range(5))
    skeleton = '<html><head><title>t</title><style>p{{}}</style></head><body><nav><ul><li><a href="/a">x</a></li></ul></nav>{}<div class="ad">{}</div><article><h1>{}</h1>{}</article><section class="comments"><p>{}</p></section><footer>&copy; y</footer><script>var a="</p>";</script></body></html>'
    pages = [(k, "u", skeleton.format("", prose(k, 9), prose(k + 50, 4), main, prose(k, 20))) for k in range(40)]
    pages += [(100, None, None), (101, "u", ""), (102, "u", "<p>cut <b off"), (0, "u", pages[0][2])]
    made = extraction.extract(spark.createDataFrame(pages, "page_id bigint, url string, html string")).collect()
    assert len(made) == len(pages)
    by_id = {r["page_id"]: r for r in made}
    for k in range(40):
        want = "\n\n".join([prose(k + 50, 4), *(f"{prose(j, 40)} & more." for j in range(5))])
        assert by_id[k]["text"] == want and by_id[k]["n_chars"] == len(want)
    assert by_id[100]["text"] == by_id[101]["text"] == ""
    none = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert extraction.extract(none).count() == 0


def test_key_filter_keeps_all(spark):
    keys = spark.range(0, 5000, 7).withColumnRenamed("id", "doc_id")
    bits = scan.key_filter(keys, scan.id_hash())
    every = spark.range(20_000).withColumnRenamed("id", "doc_id")
    hit = {r[0] for r in scan.filtered(every, scan.id_hash(), bits).collect()}
    assert set(range(0, 5000, 7)) <= hit and len(hit) < 1000


def test_a_copy_of_an_example_is_its_nearest(spark):
    texts = [f"{prose(k, 60)} only{k}word" for k in range(60)]
    labels = spark.createDataFrame([(k, 1, int(k % 10 == 0)) for k in range(60)], "doc_id bigint, quality int, toxic int")
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id bigint, text string")
    model = toxicity.train(docs, labels)
    learnt = [int(i) for i in learning.load_arrays(model)["ids"]]
    asked = [(1000 + k, texts[k]) for k in learnt] + [(2000, f"only{learnt[0]}word unheard")]
    made = {r["doc_id"]: r["evidence"] for r in toxicity.score(spark.createDataFrame(asked, docs.schema), model).collect()}
    for k in learnt:
        assert made[1000 + k][0]["doc_id"] == k and made[1000 + k][0]["cosine"] == pytest.approx(1, abs=1e-6)
    assert [e["doc_id"] for e in made[2000]] == learnt[:1] and made[2000][0]["cosine"] < 0.9


def test_index_of_frequent_and_rare_terms_is_exact():
    draw = np.random.default_rng(19)
    n, terms = 700, 200
    dense = draw.random((n, terms)) * (draw.random((n, terms)) < np.where(np.arange(terms) < 30, 0.6, 0.03))
    dense[400:420] = dense[399]
    dense /= np.maximum(np.linalg.norm(dense, axis=1, keepdims=True), 1e-9)
    example, term = np.nonzero(dense)
    index = toxicity.BlockMaxIndex(term, example, dense[example, term], terms, n)
    assert index.table.shape == (n, 30)
    for i in range(380, 420):
        t = np.flatnonzero(dense[i])
        ((near, cosine),) = index.nearest([(t, dense[i, t])], 10, [i])
        every = np.round(dense @ dense[i], 12)
        every[i] = 0
        want = np.lexsort((np.arange(n), -every))[:10]
        assert near.tolist() == want.tolist() and np.allclose(cosine, every[want])


def test_small_samples_still_tell_labels_apart(spark):
    """286 examples with 33 of label 1: most held-out documents of that label are caught, no other is."""
    sf = "/root/testdata/sf0.01"
    docs, marks = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    made = toxicity.classify(docs, marks).where("held_out").join(marks, "doc_id").select("toxic", "predicted").collect()
    toxic = [r["predicted"] for r in made if r["toxic"] == 1]
    assert sum(toxic) >= 0.7 * len(toxic) and not any(r["predicted"] for r in made if r["toxic"] == 0)


def test_calibration_adds_votes_up_without_evidence():
    votes = np.array([[2.0, 1.0], [-2.0, -1.0]])
    a, b, c = toxicity.calibrate(votes, np.array([1, 0]))
    assert a > 0.9 and b > 0.9 and abs(c) < 0.1
    assert toxicity.calibrate(votes, np.array([1, 1])).tolist()[:2] == [0.0, 0.0]
