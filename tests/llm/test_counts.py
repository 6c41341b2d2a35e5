"""Exact dedup, divergence audit and lexical search against brute force, and their edge cases."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import divergence, exact, lexical

CLASH = ["keep_id", "group_size", "kept", "_id", "_at", "_split", "_recipe", "_tm_row", "text_sha256", "n", "term", "item",
         "rank", "score", "row", "terms", "id", "query", "value", "part", "v"]


def clashing(df):
    return df.select("*", *[F.lit(f"x{i}").alias(c) for i, c in enumerate(CLASH) if c not in df.columns])


# --- exact dedup ---------------------------------------------------------------------------------------------------

@given(st.binary(max_size=9000), st.integers(0, 300))
@settings(max_examples=60, deadline=None)
def test_chunks_cover_the_text(data, seed):
    data = data * (1 + seed % 7)
    for sizes in ((512, 2048, 16384), (4, 16, 64), (1, 8, 32)):
        at = exact.ends(data, exact.gear(), *sizes)
        assert at == sorted(set(at)) and (at[-1:] == [len(data)] if data else at == [])
        assert all(b - a <= sizes[2] for a, b in zip([0, *at], at))
        assert all(b - a >= sizes[0] for a, b in zip([0, *at], at[:-1]))


def test_cuts_depend_on_content_alone():
    r = random.Random(4)
    passage = bytes(r.randrange(97, 123) for _ in range(60_000))
    a, b = exact.ends(passage, exact.gear()), exact.ends(b"x" * 777 + passage, exact.gear())
    shared = set(a) & {e - 777 for e in b}
    assert len(shared) > 0.8 * len(a)  # a shift in front leaves the cuts behind it in place


@given(st.text(alphabet="a \t\n\x0b\x0c\r\x85\xa0b", max_size=30))
@settings(max_examples=200, deadline=None)
def test_normalised(text):
    assert exact.normalised(text.encode()).decode() == re.sub("[\x20\x09-\x0d]+", " ", text)


def expect_copies(rows):
    norm = [re.sub("[\x20\x09-\x0d]+", " ", t or "") for _, t in rows]
    size, low = Counter(norm), {}
    for (i, _), t in zip(rows, norm):
        low[t] = min(low.get(t, (True, 0)), (i is None, i or 0))
    return Counter((i, None if low[t][0] else low[t][1], size[t], hashlib.sha256(t.encode()).hexdigest()) for (i, _), t in zip(rows, norm)), len(size)


@pytest.mark.parametrize("digest_bytes", [1, 16])
def test_copies(spark, digest_bytes):
    r = random.Random(digest_bytes)
    long = " ".join(str(r.random()) for _ in range(12_000))
    texts = [" ".join(r.choice("ab cd ef gh".split()) for _ in range(r.randint(0, 4))) for _ in range(150)]
    texts += [long, long.replace(" ", "\n\t"), long + " ", long + "!", long[: len(long) // 2], long[::-1]]
    texts += [str(r.random()) * 400 for _ in range(60)]
    rows = [(i if i % 11 else None, t) for i, t in enumerate(texts)] + [(900, "hot  group")] * 400 + [(899 + k, "hot\tgroup") for k in range(200)]
    rows += [(7, None), (8, ""), (9, " "), (None, "\n\n"), (None, None)]
    r.shuffle(rows)
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string").repartition(6))
    # One-byte digests of different chunks collide and must be told apart.
    out = exact.mark_copies(df, digest_bytes=digest_bytes, sizes=(64, 256, 1024)).collect()
    expected, groups = expect_copies(rows)
    assert Counter((x.doc_id, x.keep_id, x.group_size, x.text_sha256) for x in out) == expected
    assert sum(x.kept for x in out) == groups and all(x.doc_id == x.keep_id for x in out if x.kept)
    kept = exact.keep_one(df, sizes=(64, 256, 1024))
    assert kept.columns == df.columns and kept.count() == groups
    if digest_bytes == 1:
        assert exact.verified_width(df, digest_bytes=1, sizes=(64, 256, 1024)) > 1


def test_copies_of_nothing(spark):
    df = clashing(spark.createDataFrame([], "doc_id long, text string"))
    assert exact.mark_copies(df).count() == 0 and exact.keep_one(df).count() == 0
    one = spark.createDataFrame([("b", "x"), ("a", "x"), (None, "x")], "doc_id string, text string")
    assert {(x.doc_id, x.keep_id, x.kept) for x in exact.mark_copies(one).collect()} == {("b", "a", False), ("a", "a", True), (None, "a", False)}


# --- divergence audit ----------------------------------------------------------------------------------------------

def expect_audit(rows, min_docs, top):
    docs = [(lang or "", source or "", re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", "".join(c.lower() if c.isascii() else c for c in text or "")))
            for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(t for d in mine for t in set(d[2]))
        kept = [t for t, k in df.items() if k >= min_docs]
        count = {s: Counter(t for d in mine if d[1] == s for t in d[2]) for s in {d[1] for d in mine}}
        whole = sum(count.values(), Counter())

        def p(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        q, ps = p(whole), {s: p(c) for s, c in count.items()}
        for s in count:
            pair = sorted([(-sum(abs(ps[s][t] - ps[o][t]) for t in kept), o) for o in count if o != s], key=lambda x: (x[0], x[1].encode()))
            term = sorted([(-(ps[s][t] - q[t]), t) for t in kept if count[s][t] and ps[s][t] > q[t]], key=lambda x: (x[0], x[1].encode()))[:top]
            out += [(lang, s, part, item, -v, k) for part, found in (("pair", pair), ("term", term)) for k, (v, item) in enumerate(found, 1)]
    return Counter(out)


@pytest.mark.parametrize("blocks", [(256, 128), (3, 2), (1, 1)])
def test_audit(spark, blocks):
    r = random.Random(9)
    vocabulary = [a + b for a in "aeiouÄß漢" for b in "klmnöpr"]
    rows = []
    for _ in range(400):
        source = r.choice(["hot"] * 5 + ["b", "c", "d", "é", "", None])
        text = " ".join(r.choice(vocabulary[: r.randint(3, 50)]).title() + r.choice(["", "3", "!", "_x"]) for _ in range(r.randint(0, 40)))
        rows.append((r.choice([text, text, text, None, "", "77 88"]), r.choice(["en", "de", None, "", "lonely", "thin"][: r.choice([2, 4])]), source))
    rows += [("solo words only", "lonely", "b")] * 4 + [("few words", "thin", "a"), ("other", "thin", "b")]
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    df = df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(["term", "n", "docs", "doc_id", "p", "side", "x"])])
    got = divergence.audit(df, min_docs=5, top=7, block_terms=blocks[0], block_sources=blocks[1], flush_terms=20)
    assert Counter(map(tuple, got.collect())) == expect_audit(rows, 5, 7)


def test_audit_of_nothing_and_long_texts(spark):
    schema = "text string, lang string, source string"
    assert divergence.audit(spark.createDataFrame([], schema)).count() == 0
    rows = [("w " * 200_000, "en", "a"), ("v w", "en", "b")]
    got = divergence.audit(spark.createDataFrame(rows, schema), min_docs=1)
    assert Counter(map(tuple, got.collect())) == expect_audit(rows, 1, 50)


# --- lexical search ------------------------------------------------------------------------------------------------

def terms(text):
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def expect_ranking(docs, items, top):
    found = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    n_docs, length = sum(n > 0 for *_, n in found), sum(n for *_, n in found)
    df = Counter(t for _, c, _ in found for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in found:
            if n:
                m = 50 + 50 * n * n_docs // length
                s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                        for t in set(terms(text)) if c[t])
                scored.append((-s, i is None, i or 0, i))
        out += [(item, k, i, -s) for k, (s, _, _, i) in enumerate(sorted(x for x in scored if x[0] < 0)[:top], 1)]
    return Counter(out)


@given(st.lists(st.sets(st.integers(0, 25), max_size=18), min_size=1, max_size=12), st.sampled_from([2, 5, 64]))
@settings(max_examples=150, deadline=None)
def test_shared_sums_add_up(queries, width):
    sums, roots = lexical.mine([sorted(q) for q in queries], 26, width)
    content = [Counter([t]) for t in range(26)]
    for of in sums:  # children precede parents and each sum is used
        content.append(sum((content[k] for k in of), Counter()))
    for q, of in zip(queries, roots):
        assert sum((content[k] for k in of), Counter()) == Counter(q)


def test_sharing_saves_additions():
    r = random.Random(2)
    common = list(range(30))
    queries = [sorted(set(r.sample(common, 20)) | {30 + q}) for q in range(40)]
    sums, roots = lexical.mine(queries, 70)
    cost = sum(len(s) - 1 for s in sums) + sum(len(x) - 1 for x in roots)
    assert cost < 0.75 * sum(len(q) - 1 for q in queries)


@pytest.mark.parametrize("block_terms,top", [(50_000, 5), (12, 5), (50_000, 1000)])
def test_search(spark, block_terms, top):
    r = random.Random(8)
    vocabulary = ["The", "of", "and", "Ünï", "x9", "漢字"] + [f"w{i}" for i in range(40)]

    def text(n):
        return r.choice([" ", "-", "\n"]).join(r.choice(vocabulary[: r.randint(2, 46)]) for _ in range(n))

    docs = [(i if i % 17 else None, text(r.randint(0, 30))) for i in range(220)]
    docs += [(5, "the of and")] * 30 + [(700 + i, "The; OF, and") for i in range(40)] + [(1, None), (2, ""), (3, "... !!"), (4, "w1 " * 50_000)]
    items = [(k, text(r.randint(1, 15))) for k in range(12)] + [(3, "the of"), (3, "the of"), (None, "AND the"), (50, None), (51, ""), (52, "absent"), (53, "the the of")]
    r.shuffle(docs)
    df = clashing(spark.createDataFrame(docs, "doc_id long, text string").repartition(6))
    asked = clashing(spark.createDataFrame(items, "item_id long, text string"))
    got = lexical.search(df, asked, top=top, block_terms=block_terms).collect()
    assert Counter((x.item_id, x["rank"], x.doc_id, x.score) for x in got) == expect_ranking(docs, items, top)


def test_search_of_nothing(spark):
    docs = spark.createDataFrame([("a", "red fox"), (None, "red")], "doc_id string, text string")
    items = spark.createDataFrame([(1, "red")], "item_id long, text string")
    assert [(x.doc_id, x["rank"]) for x in lexical.search(docs, items).orderBy("rank").collect()] == [(None, 1), ("a", 2)]
    assert lexical.search(docs.limit(0), items).count() == 0
    assert lexical.search(docs, items.limit(0)).count() == 0
    assert lexical.search(docs.filter("text = 'none'"), items.filter("item_id = 9")).count() == 0


def test_dense_leaf_values_match_integers():
    tf, m = np.array([1, 3, 10**6], np.int64), np.array([50, 99, 10**7], np.int64)
    assert ((1_000_000_000 * tf) // (1000 * tf + 20 * m)).tolist() == [10**9 * int(a) // (1000 * int(a) + 20 * int(b)) for a, b in zip(tf, m)]
