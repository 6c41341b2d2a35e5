"""Nulls, empty and very long texts, repeated rows, empty tables and clashing names, for every operator."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import (chat, decontamination, extraction, language, mixing, quality, sharding, simhash, toxicity,
                          urls)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators return or use inside.
CLASH = ["size", "score", "predicted", "kept", "_id", "_src", "_null", "_range", "_words", "_key", "n", "u", "v", "fp",
         "root", "shard", "slot", "m", "k", "words", "held_out", "taken", "copies", "n_words", "spans", "items", "_n",
         "_hits", "_score", "_p", "_x", "_tm_row", "component_id", "id", "row", "_copy", "_hash"]


@pytest.fixture(scope="module")
def docs(spark):
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    rows = [(1, "the cat sat on the mat. The end", "en", "a", 5), (2, None, None, None, None), (3, "", "en", "b", 0),
            (4, " \t\n ", "fr", None, 4), (None, "le chat est sur le tapis et le chien dort", "fr", "b", None),
            (5, long, "en", "a", len(long)), (6, long + " tail", "en", "b", 1), (7, "123 456 !!", "de", "c", 3),
            (1, "the cat sat on the mat. The end", "en", "a", 5), (8, "der hund und die katze", "de", "c", 9)]
    df = spark.createDataFrame(rows, DOCS)
    return df.select("*", *[F.lit(f"x{i}").alias(c) for i, c in enumerate(CLASH)])


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (5, 1, None), (6, None, 1), (None, 0, 1), (8, 1, 1), (99, 0, 1), (1, 0, 0)],
                                 "doc_id long, quality int, toxic int")


def operators(spark, labels):
    items = spark.createDataFrame([(1, "The cat sat"), (2, None), (3, ""), (None, "x y"), (1, "The cat sat")],
                                  "item_id long, text string")
    return {
        "mix": lambda d: mixing.mix(d),
        "mixed_rows": lambda d: mixing.mixed_rows(d),
        "quality": lambda d: quality.quality(d, labels),
        "language": lambda d: language.identify(d, language.learn(d)),
        "simhash": lambda d: simhash.near_duplicates(d),
        "keep_one": lambda d: simhash.keep_one(d),
        "toxicity": lambda d: toxicity.score(d, toxicity.train(d, labels)),
        "shard": lambda d: sharding.shard(d),
        "items": lambda d: decontamination.find_items(d, items),
        "clean": lambda d: decontamination.clean_rows(d, items),
    }


@pytest.mark.parametrize("name", ["mix", "mixed_rows", "quality", "language", "simhash", "keep_one", "toxicity", "shard",
                                  "items", "clean"])
def test_documents(spark, docs, labels, name):
    run = operators(spark, labels)[name]
    out = run(docs).collect()
    if name not in ("mixed_rows", "keep_one", "clean"):
        assert len(out) == 10
    assert run(docs.limit(0)).count() == 0


def test_defined_results(spark, docs, labels):
    mixed = {(r.doc_id, r.size): r for r in mixing.mix(docs).collect()}
    assert mixed[(2, 0)].taken == 0 and mixed[(3, 0)].taken == 0
    judged = quality.quality(docs, labels).filter("doc_id IN (2, 3, 4)").collect()
    assert all(r.base_failed and not r.kept and r.n_words == 0 for r in judged)
    found = language.identify(docs, language.learn(docs)).filter("doc_id IN (2, 3, 4, 7)").collect()
    assert {r.lang_pred for r in found} == {"und"} and {r.score for r in found} == {0.0}
    marks = simhash.near_duplicates(docs).filter("id IN (2, 3, 4)").collect()
    assert {(r.fingerprint, r.component_id) for r in marks} == {("0" * 16, 2)}
    kept = sorted(r.doc_id or -1 for r in simhash.keep_one(docs).collect())
    assert kept == [-1, 1, 2, 5, 7, 8]  # 5 and 6 are near copies, row 1 was repeated
    placed = sharding.shard(docs, shards=3).collect()
    assert {r["size"] for r in placed if r.doc_id in (2, 3)} == {16}
    assert {r.text_crc32 for r in placed if r.doc_id in (2, 3)} == {0}


def test_items_without_id_are_found(spark):
    items = spark.createDataFrame([(None, "red fox ran"), (None, "old owl"), (7, "red fox ran"), (None, None), (10, "one two")],
                                  "item_id long, text string")
    docs = spark.createDataFrame([(1, "the red fox ran off"), (2, "an old owl sat"), (3, "nothing here"), (4, "one two"),
                                  (5, None), (6, "one two old owl red fox ran")], "doc_id long, text string")
    got = {r.doc_id: (r.n_hit, [tuple(s) for s in r.spans], r["items"]) for r in decontamination.find_items(docs, items).collect()}
    assert got == {1: (3, [(1, 4)], ["7", None]), 2: (2, [(1, 3)], [None]), 3: (0, [], []), 4: (2, [(0, 2)], ["10"]),
                   5: (0, [], []), 6: (7, [(0, 7)], ["10", "7", None])}
    assert [r.doc_id for r in decontamination.clean_rows(docs, items).orderBy("doc_id").collect()] == [3, 5]


def test_pages_and_turns(spark):
    pages = spark.createDataFrame([(1, "u", None), (2, None, ""), (None, "u", " <p>"), (4, "u", "<p>a" + "<div>" * 3000),
                                   (5, "u", "<article><p>one &amp; two<br>three <b>four"), (5, "u", "<article><p>one &amp; two<br>three <b>four")],
                                  "page_id long, url string, html string").select("*", F.lit(1).alias("text"), F.lit(2).alias("_x"))
    model = extraction.train(pages)
    got = extraction.extract(pages, model).collect()
    assert len(got) == 6 and all(r.text == "" and r.n_chars == 0 for r in got if r.page_id in (1, 2, None))
    assert {r.text for r in got if r.page_id == 5} == {"one & two three four"}
    assert extraction.extract(pages.limit(0), extraction.train(pages.limit(0))).count() == 0

    turns = spark.createDataFrame([(1, 0, "user", None), (1, None, None, "x"), (None, 0, "assistant", "y"), (1, 0, "user", None)],
                                  "conv_id long, turn long, role string, text string").select("*", F.lit(0).alias("id"), F.lit("p").alias("parts"))
    out = {r.conv_id: r for r in chat.format_conversations(turns).collect()}
    assert out[1].n_turns == 3 and out[None].n_turns == 1 and chat.read_back(out[1].formatted)[0] == ("", "x")
    assert chat.format_conversations(turns.limit(0)).count() == 0


def test_captures(spark):
    day = dt.date
    entries = spark.createDataFrame([("a.org", "block", day(2024, 1, 5)), ("a.org", "remove", day(2024, 1, 10)),
                                     (None, "block", day(2024, 1, 1)), ("b.org", "block", None),
                                     ("a.org/ok/", "allow", day(2024, 1, 6))], "pattern string, action string, listed_at date")
    captures = spark.createDataFrame(
        [("http://a.org/x", day(2024, 1, 4)), ("http://www.A.org./x", day(2024, 1, 5)), ("http://a.org/x", day(2024, 1, 10)),
         ("http://u@a.org:8080/ok/y?z#f", day(2024, 1, 7)), (None, day(2024, 1, 7)), ("http://a.org", None), ("nonsense", day(2024, 1, 7)),
         ("http://nota.org/", day(2024, 1, 7)), ("http://a.org/" + "d/" * 20_000, day(2024, 1, 7))],
        "url string, fetched_at date").select("*", F.lit("q").alias("pattern"), F.lit("w").alias("_host"))
    got = [r.verdict for r in urls.judge(captures, entries).orderBy(F.length("url").asc_nulls_first(), "url", "fetched_at").collect()]
    assert got == ["none", "none", "none", "none", "none", "none", "block", "allow", "block"]
    assert urls.judge(captures.limit(0), entries).count() == 0
    assert {r.verdict for r in urls.judge(captures, entries.limit(0)).collect()} == {"none"}


def test_pipeline_stages_keep_columns(spark, docs, tmp):
    docs.write.parquet(f"{tmp}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp}/labels.parquet")
    spark.createDataFrame([(1, "unseen words only")], "item_id long, text string").write.parquet(f"{tmp}/benchmark.parquet")
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, plain, tmp).columns == plain.columns, name
    assert corpus_pipeline.run(spark, tmp).select("shard", "slot").distinct().count() == corpus_pipeline.run(spark, tmp).count()
