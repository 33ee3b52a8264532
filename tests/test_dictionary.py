"""Listed names by the automaton, against the join and against counting by hand."""

import random
import re
import sys
import time
import unicodedata
from collections import Counter

from pyspark.sql import functions as F

from vellumark.operators import enrichment
from vellumark.operators.dictionary import Automaton, token_pattern

ODD = "don't İstanbul ǅ ª ² ½ Ⅷ 東京タワー é  x y a_b 12٣ \x0b tab\tnew\nline 𝒳 🙂 ﬁ U.S. C++"


def by_hand(names, text):
    tokens = token_pattern().findall(text)
    found = Counter()
    for name in set(names):
        own = token_pattern().findall(name)
        found[name] = sum(tokens[i : i + len(own)] == own for i in range(len(tokens) - len(own) + 1)) if own else 0
    return {k: v for k, v in found.items() if v}


def test_tokens_are_those_of_the_pattern(spark):
    df = spark.createDataFrame([(ODD,)], "text string")
    got = df.select(F.regexp_extract_all("text", F.lit(enrichment.TOKEN_PATTERN), F.lit(0))).first()[0]
    assert token_pattern().findall(ODD) == got


def test_tokens_of_every_sign():
    signs = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    word = [c.isascii() and (c.isalnum() or c == "_") or not c.isascii() and unicodedata.category(c).startswith("L") for c in signs]
    together, joined = token_pattern().findall("".join(signs)), []
    for c, in_word, before in zip(signs, word, [False, *word]):
        if in_word and before:
            joined[-1] += c
        elif c not in " \t\n\x0b\f\r":
            joined.append(c)
    assert together == joined
    assert token_pattern().findall(" ".join(signs)) == [c for c in signs if c not in " \t\n\x0b\f\r"]


def test_tokens_are_cut_about_as_fast_as_plain_words():
    text = "Ein Wort, zwei Wörter: a place in Île-de-France. " * 2000

    def seconds(pattern):
        times = []
        for _ in range(5):
            begin = time.process_time()
            pattern.findall(text)
            times.append(time.process_time() - begin)
        return min(times)

    assert seconds(token_pattern()) < 4 * seconds(re.compile(r"\w+|[^\w\s]"))


def test_automaton_equals_counting():
    draw = random.Random(3)
    words = ["a", "b", "c", "d", "."]
    for _ in range(200):
        names = [" ".join(draw.choices(words, k=draw.randint(1, 4))) for _ in range(draw.randint(0, 12))]
        text = "  ".join(draw.choices([*words, "other"], k=draw.randint(0, 30)))
        automaton = Automaton(names)
        got = {automaton.names[i]: n for i, n in automaton.count(text).items()}
        assert got == by_hand(names, text)


def test_both_ways_agree(spark):
    draw = random.Random(4)
    words = ["New", "York", "City", "São", "Paulo", "of", "the", "-", "U", ".", "S"]
    names = [(" ".join(draw.choices(words, k=draw.randint(1, 3))),) for _ in range(30)] + [("",), (None,), ("U.S.",), ("  ",)]
    rows = [(i, " ".join(draw.choices([*words, "x", "\n"], k=40))) for i in range(50)] + [(50, None), (51, ""), (52, "U.S. U . S .")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    listed = spark.createDataFrame(names, "name string")
    quick = sorted(tuple(r) for r in enrichment.places(df, listed).collect())
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(tuple(r) for r in enrichment.places(df, listed).collect()) == quick
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(quick) > 100
    assert enrichment.places(df, listed.where("name = 'nothing'")).count() == 0


def test_many_names(spark):
    names = spark.range(100_000).select(F.concat_ws(" ", F.lit("Place"), F.hex(F.xxhash64("id"))).alias("name"))
    texts = names.limit(500).select(F.monotonically_increasing_id().alias("doc_id"), F.concat(F.lit("Near Place "), "name", F.lit(".")).alias("text"))
    found = enrichment.places(texts, names)
    assert found.count() == 500 and found.agg(F.sum("occurrences")).first()[0] == 500
