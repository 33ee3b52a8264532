"""Fill-in-middle against the plain rule, and exact restoration."""

import hashlib
import re

import pytest

from vellumark.llm import fill_middle

SCHEMA = "doc_id bigint, text string, row string, place bigint, form string, piece bigint, output string"
ODD = ["", None, " ", "a", "ab", "é", "<P>", "x <S> y", "a<M", "M><P", "<<<P", "don't 12 <S", "日本語 text\n\nmore\r", "\x00zero", "𝒳 wide 🙂", "S>P>M>"]


def plain_rule(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h[3] % 100 < 20 else "psm"
    return doc_id, n, form, len(p), len(m), f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def rows():
    texts = ODD * 8 + ["word, " * 40_000, "a" * 300_000, "é" * 150_000, "<" * 70_000, "ab <S" * 30_000] * 4
    return [(k, t) for k, t in enumerate(texts)] + [(5, "same row")] * 40 + [(None, "no id at all"), (-3, "negative id here")]


def frame(spark, rows):
    return spark.createDataFrame([(k, t, "clash", 1, "clash", 2, "clash") for k, t in rows], SCHEMA).repartition(5)


def test_digests_equal_the_plain_rule(spark, rows):
    got = fill_middle.transform_digests(frame(spark, rows)).collect()
    want = [(*(w := plain_rule(k, t))[:5], sha(w[5]), sha(t or "")) for k, t in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_texts_and_restoration_from_output_and_form(spark, rows):
    outputs = fill_middle.transform(frame(spark, rows))
    got = outputs.collect()
    want = [plain_rule(k, t) for k, t in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    back = fill_middle.restore(outputs.select("form", "output")).collect()
    texts = sorted((w[2], w[5], t or "") for w, (_, t) in zip(want, rows))
    assert sorted(map(tuple, back)) == texts


def test_empty_tables_and_nulls(spark):
    assert fill_middle.transform_digests(frame(spark, [])).count() == 0
    made = spark.createDataFrame([(None, None), ("plain", "x"), ("psm", "<P>a<S>c<M>b")], "form string, output string")
    assert sorted(map(tuple, fill_middle.restore(made).select("form", "text").collect())) == [("plain", ""), ("plain", "x"), ("psm", "abc")]


@pytest.mark.parametrize("bytes_", [1, 2, 3, 5, 64])
def test_marks_across_pieces(bytes_):
    text = "<P>left <S <S>right <M M> <M>mid <"
    read = fill_middle._unmarked("psm")
    data = text.encode()
    cuts = [data[k : k + bytes_] for k in range(0, len(data), bytes_)]
    parts = [p for k, c in enumerate(cuts) for p in read(c, k == len(cuts) - 1)]
    joined = {s: b"".join(x for w, x in parts if w == s) for s in (0, 1, 2)}
    assert joined == {0: b"left <S ", 1: b"mid <", 2: b"right <M M> "}
