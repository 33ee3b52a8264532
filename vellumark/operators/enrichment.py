"""Enrichment of documents by countable rules instead of a served model."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellumark.functions.values import counted, let
from vellumark.functions.xml import ordered_text
from vellumark.operators.dictionary import Automaton
from vellumark.operators.pairings import all_alternates
from vellumark.operators.skew import fits_broadcast, join_unique
from vellumark.operators.term_blocks import Cells, inverse_frequency, numbered_terms, per_block, term_blocks
from vellumark.operators.text_chunks import sentences
from vellumark.operators.topics import strongest_terms, topic_model
from vellumark.session import stored

# What counts as a term, a date, a spanning name.
TERM = r"\p{L}+"
DAY_PATTERN = r"[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}"
NAME_PATTERN = r"\p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)+"
TOKEN_PATTERN = r"[\p{L}0-9_]+|[^\p{L}0-9_ \t\n\x0B\f\r]"  # a word or one other sign
# Last words of an organisation's name.
ORGANISATION_WORDS = (
    "Agency", "Association", "Bank", "Company", "Corp", "Corporation", "Desk", "Foundation", "Group", "Inc", "Institute",
    "Limited", "Ltd", "Ministry", "Office", "University",
)
# What may stand before and after a number or a code: no letter, digit or underscore of ASCII.
_BEFORE, _AFTER = "(?<![0-9A-Za-z_])", "(?![0-9A-Za-z_])"
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
# Personal data by kind.
PII_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "phone": (
        rf"\+[0-9]{{1,3}}[ .-]?(?:\([0-9]{{1,4}}\)|[0-9]{{1,4}})(?:[ .-]?[0-9]{{2,4}}){{2,5}}{_AFTER}"
        rf"|\([0-9]{{3}}\) ?[0-9]{{3}}[ .-][0-9]{{4}}{_AFTER}"
        rf"|{_BEFORE}[0-9]{{3}}[ .-][0-9]{{3}}[ .-][0-9]{{4}}{_AFTER}"
    ),
    "ipv4": rf"{_BEFORE}{_OCTET}(?:\.{_OCTET}){{3}}{_AFTER}",
    "card": rf"{_BEFORE}(?:[0-9]{{13,19}}|[0-9]{{4}}(?:[ -][0-9]{{4}}){{3}}){_AFTER}",
    "national_id": rf"{_BEFORE}[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}{_AFTER}",
    "iban": rf"{_BEFORE}[A-Z]{{2}}[0-9]{{2}}(?:[0-9A-Z]{{11,30}}|(?: [0-9A-Z]{{4}}){{3,7}}(?: [0-9A-Z]{{1,3}})?){_AFTER}",
}
# Words that point to a purpose.
INTENT_CUES = {
    "agreement": ("license", "agreement", "terms", "copyright", "warranty"),
    "contact": ("call", "email", "contact", "reply", "phone"),
    "explanation": ("because", "therefore", "thus", "that", "which"),
    "instruction": ("please", "must", "should", "use", "run"),
    "report": ("report", "summary", "result", "total", "for"),
}
NO_INTENT = "unknown"
USUAL_SHARE = 8  # a term of one in so many uses of a place is usual there


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def _idf_of(own: pa.Table) -> np.ndarray:
    """idf by place in the block."""
    at = own.column("at").to_numpy()
    idf = np.zeros(int(at.max(initial=-1)) + 1)
    idf[at] = own.column("idf").to_numpy()
    return idf


def _candidates(own: pa.Table, cells: Cells, top: int) -> pa.Table:
    """key, term, score of the terms of each text that may be among its `top`: equal scores by term, near ones all."""
    score = cells.n * _idf_of(own)[cells.at]
    order = np.lexsort((cells.at, -score, cells.of))
    of, at, score = cells.of[order], cells.at[order], score[order]
    index = np.arange(len(of))
    begin = np.searchsorted(of, of)
    run = np.ones(len(of), bool)
    run[1:] = (of[1:] != of[:-1]) | (score[1:] != score[:-1])
    among_equal = index - np.maximum.accumulate(np.where(run, index, 0))
    last = np.minimum(begin + top, np.searchsorted(of, of, "right")) - 1
    kept = (among_equal < top) & (score >= score[last] - 2e-6)  # what rounding to 6 digits can bring together
    names = np.empty(int(own.column("at").to_numpy().max(initial=-1)) + 1, np.int64)
    names[own.column("at").to_numpy()] = np.arange(own.num_rows)
    terms_ = own.column("term").take(pa.array(names[at[kept]]))
    return pa.table([cells.keys.column(0).take(pa.array(of[kept])), terms_, pa.array(score[kept])], names=["key", "term", "score"])


def keywords(df: DataFrame, key: str = "doc_id", text: str = "text", top: int = 10) -> DataFrame:
    """key, rank, term, score: the terms of highest TF-IDF, equal ones by term. Only candidates are shuffled by key."""
    found, blocks = term_blocks(df.select(key, terms(F.col(text)).alias("_terms")), "_terms", [key])
    return _best_terms(inverse_frequency(found, blocks), blocks, key, df.schema[key].dataType.simpleString(), top)


def _best_terms(weighed: DataFrame, blocks: DataFrame, key: str, kind: str, top: int) -> DataFrame:
    """key, rank, term, score of weighed terms of blocks (block, at, idf, and term or anything of its order)."""
    columns = f"key {kind}, term {weighed.schema['term'].dataType.simpleString()}, score double"
    chosen = per_block(weighed, blocks, lambda own, cells: _candidates(own, cells, top), columns)
    best = Window.partitionBy(key).orderBy(F.desc("score"), "term")
    return (
        chosen.select(F.col("key").alias(key), "term", F.round("score", 6).alias("score"))
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= top)
        .select(key, "rank", "term", "score")
    )


def _sentence_scores(own: pa.Table, cells: Cells) -> pa.Table:
    score = np.bincount(cells.of, cells.n * _idf_of(own)[cells.at], len(cells.sizes)).astype(np.float64)  # without any cell, too
    some = pa.array(np.flatnonzero(cells.sizes))
    at = cells.keys.column("part").take(some).cast(pa.int32())
    return pa.table([cells.keys.column(0).take(some), at, pa.array(score).take(some)], names=["key", "at", "score"])


def summaries(df: DataFrame, key: str = "doc_id", text: str = "text", top: int = 5) -> DataFrame:
    """key, summary: the sentences of highest TF-IDF, in text order. Of the sentences only scores are shuffled."""
    parts = df.select(key, F.transform(sentences(F.col(text)), terms).alias("_terms"))
    found, blocks = term_blocks(parts, "_terms", [key])
    columns = f"key {df.schema[key].dataType.simpleString()}, at int, score double"
    each = per_block(inverse_frequency(found, blocks), blocks, _sentence_scores, columns).withColumnRenamed("key", key)
    scored = each.groupBy(key, "at").agg(F.round(F.sum("score"), 6).alias("score"))
    best = Window.partitionBy(key).orderBy(F.desc("score"), "at")
    chosen = (
        scored.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= top)
        .groupBy(key)
        .agg(F.sort_array(F.collect_list("at")).alias("ats"))
    )
    # One shuffle of the texts, to meet their few sentence numbers.
    cut = sentences(F.col(text))
    return df.select(key, cut.alias("s")).join(chosen, key).select(
        key, F.array_join(F.transform("ats", lambda i: F.get("s", i)), " ").alias("summary")
    )


def _counted_rows(df: DataFrame, key: str, found: Column) -> DataFrame:
    """key, kind, value, occurrences of an array of (kind, value), counted within the row."""
    return df.select(key, F.explode(counted(found)).alias("c")).select(
        key, "c.term.kind", "c.term.value", F.col("c.n").alias("occurrences")
    )


def _matches(text: Column, kind: str, pattern: str) -> Column:
    """Array of (kind, value) for every match."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.transform(found, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value")))


def _tokens(text: Column) -> Column:
    """Words and other signs, each with a space after it."""
    found = F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), F.lit(0))
    return F.transform(found, lambda t: F.concat(t, F.lit(" ")))


def places(df: DataFrame, gazetteer: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, kind `place`, value, occurrences: listed names of any number of words, wherever their words follow each other.

    A gazetteer below the broadcast threshold becomes an automaton that every
    task runs once over its texts. A larger one is joined: a text gives, once
    for each distinct one, the runs of as many tokens as the longest name has;
    a run meets the names that begin with its first token.
    """
    names = stored(gazetteer.select("name").where(F.col("name").rlike(TOKEN_PATTERN)).distinct(), "names")
    if fits_broadcast(names):
        return _automaton_places(df, names, key, text)
    return _joined_places(df, names, key, text)


def _automaton_places(df: DataFrame, names: DataFrame, key: str, text: str) -> DataFrame:
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(Automaton(r["name"] for r in names.collect()))  # below the broadcast threshold
    kind = df.schema[key].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value
        for batch in batches:
            rows, values, counts = [], [], []
            for i, body in enumerate(batch.column("text").to_pylist()):
                for name, n in automaton.count(body or "").items():
                    rows.append(i)
                    values.append(automaton.names[name])
                    counts.append(n)
            keys = batch.column("key").take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([keys, pa.array(values, pa.string()), pa.array(counts, pa.int64())], names=["key", "value", "occurrences"])

    found = df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(find, f"key {kind}, value string, occurrences bigint")
    return found.groupBy(F.col("key").alias(key), F.lit("place").alias("kind"), "value").agg(F.sum("occurrences").alias("occurrences"))


def _joined_places(df: DataFrame, names: DataFrame, key: str, text: str) -> DataFrame:
    names = names.select("name", _tokens(F.col("name")).alias("t"))
    longest = names.agg(F.max(F.size("t"))).first()[0] or 1
    listed = names.groupBy(F.get("t", F.lit(0)).alias("first")).agg(
        F.collect_list(F.struct("name", F.array_join("t", "").alias("tokens"))).alias("names")
    )

    def runs(t: Column) -> Column:
        return F.transform(
            t, lambda x, i: F.struct(x.alias("first"), F.array_join(F.slice(t, i + 1, longest), "").alias("run"))
        )

    found = df.select(key, F.explode(counted(let(_tokens(F.col(text)), runs))).alias("c"))
    met = join_unique(
        found.select(key, "c.term.first", "c.term.run", "c.n"), stored(listed, "places"), "first", "inner"
    )
    named = met.select(
        key, "n", F.explode(F.filter("names", lambda x: F.startswith(F.col("run"), x["tokens"]))).alias("x")
    )
    return named.groupBy(key, F.lit("place").alias("kind"), F.col("x.name").alias("value")).agg(
        F.sum("n").alias("occurrences")
    )


def entities(df: DataFrame, gazetteer: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, kind, value, occurrences: dates, capitalised names, and listed places.

    A name of several capitalised words is an organisation if its last word is
    one of ORGANISATION_WORDS, else a person. Only places are joined.
    """
    body = F.col(text)
    found = F.concat(
        _matches(body, "date", DAY_PATTERN),
        F.transform(
            F.regexp_extract_all(body, F.lit(NAME_PATTERN), F.lit(0)),
            lambda v: F.struct(
                F.when(F.substring_index(v, " ", -1).isin(*ORGANISATION_WORDS), "organisation").otherwise("person").alias("kind"),
                v.alias("value"),
            ),
        ),
    )
    return _counted_rows(df, key, found).unionByName(places(df, gazetteer, key, text))


def luhn_valid(number: Column) -> Column:
    """Check digit test over the digits of a card number."""
    digits = F.transform(
        F.split(F.reverse(F.regexp_replace(number, "[^0-9]", "")), ""), lambda d: d.cast("int")
    )
    weighed = F.transform(
        digits,
        lambda d, i: F.when(i % 2 == 0, d).otherwise(F.when(d > 4, d * 2 - 9).otherwise(d * 2)),
    )
    return F.aggregate(weighed, F.lit(0), lambda s, d: s + d) % 10 == 0


def personal_data(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, kind, value, occurrences; card numbers must pass the check digit. Map-only."""
    found = F.concat(*[_matches(F.col(text), kind, pattern) for kind, pattern in PII_PATTERNS.items()])
    kept = F.filter(found, lambda e: (e["kind"] != "card") | luhn_valid(e["value"]))
    return _counted_rows(df, key, kept)


def intents(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    cues: Mapping[str, Sequence[str]] = INTENT_CUES,
) -> DataFrame:
    """key, intent, score: the purpose with most cue words, equal ones by name; a null text has none. Map-only."""
    counted = df.withColumn("_t", terms(F.coalesce(F.col(text), F.lit(""))))

    def score(name: str, words: Sequence[str]) -> Column:
        hits = F.size(F.filter("_t", lambda t: t.isin(*words)))
        return F.struct((-hits).alias("minus"), F.lit(name).alias("name"))

    scores = F.array(*[score(name, words) for name, words in cues.items()])
    best = F.array_min(scores)
    return counted.withColumn("_b", best).select(
        key,
        F.when(F.col("_b.minus") < 0, F.col("_b.name")).otherwise(NO_INTENT).alias("intent"),
        (-F.col("_b.minus")).cast("bigint").alias("score"),
    )


def _ordered_blocks(df: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    return term_blocks(df.select(key, terms(F.col(text)).alias("_terms")), "_terms", [key], ordered=True)


def _named(best: DataFrame, numbered: DataFrame) -> DataFrame:
    """term, rank, alternate, score and id of all_alternates."""
    own, others = numbered.select("id", "term"), numbered.select(F.col("id").alias("other"), F.col("term").alias("alternate"))
    return join_unique(join_unique(best, own, "id", "inner"), others, "other", "inner")


def alternates(
    df: DataFrame, key: str = "doc_id", text: str = "text", share: int | None = USUAL_SHARE, top: int = 5, asked: DataFrame | None = None
) -> DataFrame:
    """term, rank, alternate, score: terms used in the same places; of the terms of `asked` only, if it is given.

    Without a `share`, every term of a place is an alternate of all others there.

    A place is the pair of neighbouring terms; a term is usual there if it
    makes up at least one in `share` of the place's uses, whatever their
    number. A term scores with an alternate the smaller of their counts, summed
    over the places that the term occurs in and the alternate is usual in. By
    its definition a place has at most `share` usual terms, none where any term
    fits, so each (place, term) meets a bounded number of them.
    """

    if share is None:
        found, blocks = _ordered_blocks(df, key, text)
        numbered = numbered_terms(found, blocks)
        ids = None if asked is None else numbered.join(asked.select("term").distinct(), "term", "left_semi").select("id")
        return _named(all_alternates(found, blocks, numbered, ids, top), numbered).select("term", "rank", "alternate", "score")

    def triples(t: Column) -> Column:
        return F.transform(
            F.when(F.size(t) >= 3, F.sequence(F.lit(1), F.size(t) - 2)),
            lambda i: F.struct(
                F.concat_ws(" ", F.get(t, i - 1), F.get(t, i + 1)).alias("place"), F.get(t, i).alias("term")
            ),
        )

    used = stored(
        df.select(F.explode(let(terms(F.col(text)), triples)).alias("p"))
        .groupBy("p.place", "p.term")
        .agg(F.count("*").alias("n")),
        "places",
    )
    uses = F.sum("n").over(Window.partitionBy("place"))
    usual = (
        used.withColumn("uses", uses)
        .filter(F.col("n") * share >= F.col("uses"))
        .groupBy("place")
        .agg(F.collect_list(F.struct(F.col("term").alias("alternate"), F.col("n").alias("m"))).alias("usual"), F.max("uses").alias("uses"))
    )
    # A place with one term offers no alternate.
    usual = stored(usual.filter(F.col("usual")[0]["m"] < F.col("uses")).drop("uses"), "usual")
    if asked is not None:
        used = used.join(asked.select("term").distinct(), "term", "left_semi")
    met = (
        join_unique(used, usual, "place", "inner")
        .select("term", "n", F.explode("usual").alias("u"))
        .filter(F.col("term") != F.col("u.alternate"))
        .groupBy("term", F.col("u.alternate").alias("alternate"))
        .agg(F.sum(F.least("n", "u.m")).alias("score"))
    )
    best = Window.partitionBy("term").orderBy(F.desc("score"), "alternate")
    return met.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top).select(
        "term", "rank", "alternate", "score"
    )


def synonyms(
    df: DataFrame, key: str = "doc_id", text: str = "text", share: int | None = None, top: int = 5
) -> DataFrame:
    """key, term, rank, alternate, score for the keywords of each document; all terms of a place are alternates, unless there is a `share`."""
    if share is None:
        # Words are cut out of the texts once; keywords and alternates are terms' numbers until the end.
        found, blocks = _ordered_blocks(df, key, text)
        numbered = numbered_terms(found, blocks)
        weighed = found.select("block", "at", "term").join(numbered, "term").select("block", "at", F.col("id").alias("term"), "idf")
        best = _best_terms(weighed, blocks.drop("sequence"), key, df.schema[key].dataType.simpleString(), 10)
        asked = stored(best.select(key, F.col("term").alias("id")), "keywords")
        met, by = _named(all_alternates(found, blocks, numbered, asked, top), numbered), "id"
    else:
        asked = stored(keywords(df, key, text).select(key, "term"), "keywords")
        met, by = alternates(df, key, text, share, top, asked), "term"
    lists = met.groupBy(by).agg(
        F.first("term").alias("_own"), F.sort_array(F.collect_list(F.struct("rank", "alternate", "score"))).alias("a")
    )
    met = join_unique(asked, stored(lists, "alternates"), by, "inner")
    return met.select(key, F.col("_own").alias("term"), F.explode("a").alias("x")).select(
        key, "term", "x.rank", "x.alternate", "x.score"
    )


def topics(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    k: int = 10,
    iterations: int = 10,
    seed: int = 42,
    min_documents: int = 1,
) -> DataFrame:
    """key, topic, label: the main topic of each document, named by its three strongest terms.

    The model counts terms of at least `min_documents` documents, by default
    all. A text without counted terms, a null one too, has no topic (null) and
    an empty label.
    """
    tokens = df.select(key, terms(F.coalesce(F.col(text), F.lit(""))).alias("all"))
    kept = StopWordsRemover(inputCol="all", outputCol="words").transform(tokens)
    rows = stored(kept.select(key, "words", F.monotonically_increasing_id().alias("_row")), "topic-rows")
    model = topic_model(rows, "words", k, iterations, seed, min_documents)
    if model is None:
        return df.select(key, F.lit(None).cast("int").alias("topic"), F.lit("").alias("label"))
    named = F.array(*[F.lit(x) for x in strongest_terms(model[1], k)])
    scored = join_unique(rows.select(key, "_row"), model[0], "_row")
    return scored.select(key, "topic").withColumn("label", F.coalesce(F.get(named, F.col("topic")), F.lit("")))


def _listed(found: DataFrame, key: str, column: str, order: Column, entry: Column, sep: str) -> DataFrame:
    """The entries of each document as one text; a document has few of them."""
    return found.groupBy(key).agg(ordered_text(order, entry, sep).alias(column))


def enrich(
    df: DataFrame, gazetteer: DataFrame, key: str = "filename", text: str = "text"
) -> DataFrame:
    """One row per document with all enrichments as texts, "" where nothing was found."""
    kind_value = F.concat_ws(": ", "kind", "value")
    parts = [
        summaries(df, key, text),
        _listed(keywords(df, key, text), key, "keywords", F.col("rank"), F.col("term"), ", "),
        topics(df, key, text).select(key, F.col("label").alias("topic")),
        _listed(entities(df, gazetteer, key, text), key, "named_entities", kind_value, kind_value, "; "),
        _listed(personal_data(df, key, text), key, "pii_entities", kind_value, kind_value, "; "),
        intents(df, key, text).select(key, "intent"),
    ]
    alternate = _listed(
        synonyms(df, key, text).withColumn("_o", F.struct("term", "rank")), key, "synonyms", F.col("_o"),
        F.concat_ws(": ", "term", "alternate"), "; ",
    )
    out = df.select(key)
    for part in [*parts, alternate]:
        out = out.join(part, key, "left")
    return out.fillna("")
