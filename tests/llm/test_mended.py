"""Long texts, large alphabets, long pages, large benchmarks, ids beside nulls: what operators must not lose or hold."""

import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat, common, decontamination, extraction, html_blocks, language, quality, toxicity, urls

SF = "/root/testdata/sf0.1"


def prose(r, letters, n, longest=7):
    return " ".join("".join(r.choice(letters) for _ in range(r.randint(1, longest))) for _ in range(n))


def naive_phrases(text, sample):
    count, at = 0, 0
    while at < len(text):
        end = at + 1
        while end < len(text) and text[at:end + 1] in sample:
            end += 1
        count, at = count + 1, end
    return count


# --- language identification ----------------------------------------------------------------------------------------

@pytest.mark.parametrize("block, few", [(1, 0), (2, 3), (7, 0), (64, 64), (1024, 64)])
def test_counts_are_those_of_the_uncut_text(block, few):
    r = random.Random(block)
    samples = {"aa": f" {prose(r, 'abcde', 120)} ", "bb": f" {prose(r, 'cdefgh', 120)} ", "cc": " ab ab ab abc "}
    parser = language.Parser(samples)
    texts = ["", " a ", f" {prose(r, 'abcdefghxy', 700)} ", " " + "abc de " * 300, " " + "abab " * 200, f" {prose(r, 'abcde', 40)} "]
    got = parser.phrases([parser.encode(t) for t in texts], block, few)
    assert got.tolist() == [[naive_phrases(t, samples[n]) if t else 0 for n in parser.names] for t in texts]


def test_prediction_of_a_long_text_is_the_cross_parse():
    r = random.Random(3)
    samples = {n: f" {prose(r, a, 900)} " for n, a in (("aa", "abcdefgh"), ("bb", "abcdefgi"), ("cc", "mnopq"))}
    parser = language.Parser(samples)
    text = prose(r, "abcdefghi", 2400)
    assert len(text) > 10_000
    cost = {n: naive_phrases(f" {text} ", s) * np.log2(len(s) + 1) for n, s in samples.items()}
    low, second = sorted(cost.values())[:2]
    assert parser.predict([text]) == [(min(cost, key=cost.get), pytest.approx(second / (second + low)))]


def test_large_alphabets_take_memory_by_their_letters():
    r = random.Random(5)
    letters = [chr(0x4E00 + i) for i in range(3000)]
    tracemalloc.start()
    parser = language.Parser({f"l{k}": f" {prose(r, letters, 4000, 5)} " for k in range(4)})
    parser.predict([prose(r, letters, 3000, 5)])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200e6 and parser.check.nbytes + parser.target.nbytes < 20e6


def test_many_languages_learn_from_whole_texts(spark):
    r = random.Random(6)
    rows = [(i, prose(r, [chr(0x400 + 3 * (i % 120) + j) for j in range(3)], 30), f"l{i % 120}") for i in range(480)]
    rows += [(1000, "q" * 30_000, "l0"), (1001, "only " * 6000, "long"), (1002, "only " * 7000, "long"), (1003, None, "none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    samples = language.learn(docs, per_language=2)
    assert len(samples) >= 110 and "q" not in samples["l0"]     # long texts are passed over
    assert "long" not in samples or samples["long"].count("only") in (6000, 7000)  # but never cut
    right = language.identify(docs, samples).filter("doc_id < 480 AND lang = lang_pred").count()
    assert right > 0.9 * 480 * len([s for s in samples if s[0] == "l" and s != "long"]) / 120


# --- chat, urls ------------------------------------------------------------------------------------------------------

def test_long_ids_beside_a_null_stay_apart(spark):
    ids = [None, 2**53, 2**53 + 1, 2**53 + 2, 2**53 + 3, -(2**63), 2**63 - 1]
    rows = spark.createDataFrame([(i, 0, "user", str(i)) for i in ids], "conv_id long, turn long, role string, text string")
    out = chat.format_conversations(rows).collect()
    assert Counter(x.conv_id for x in out) == Counter(ids) and all(x.n_turns == 1 for x in out)
    assert {x.conv_id: chat.read_back(x.formatted)[0][1] for x in out} == {i: str(i) for i in ids}
    binary = spark.createDataFrame([(b"\xff\x00", 0, "user", "x"), (None, 0, "user", "y")], "conv_id binary, turn long, role string, text string")
    assert {None if x.conv_id is None else bytes(x.conv_id) for x in chat.format_conversations(binary).collect()} == {b"\xff\x00", None}


def test_bracketed_addresses(spark):
    import datetime as dt
    entries = spark.createDataFrame([("[2001:db8::1]", "block", dt.date(2024, 1, 1))], "pattern string, action string, listed_at date")
    captures = spark.createDataFrame([(u, dt.date(2024, 1, 2)) for u in ("http://[2001:DB8::1]/", "https://u@[2001:db8::1]:8080/x?y", "http://[2001:db8::2]/", "http://[broken/")],
                                     "url string, fetched_at date")
    got = {x.url: x.verdict for x in urls.judge(captures, entries).collect()}
    assert list(got[u] for u in sorted(got)) == ["block", "none", "none", "block"]


# --- decontamination -------------------------------------------------------------------------------------------------

def test_one_block_is_built_once_and_small():
    r = random.Random(8)
    rows = [(str(i), prose(r, "abcdefghij", 60)) for i in range(3000)]
    size = sum(len(t) for _, t in rows)

    class Sent:
        value = {"rows": rows}

    built, real = [], decontamination.PatternSet
    try:
        decontamination.PatternSet = lambda *a: built.append(1) or real(*a)
        import pandas as pd
        run = decontamination.search_udf(Sent, 13).func
        out = list(run(iter([pd.Series([rows[k][1], "no word of it", None]) for k in range(4)])))
        out += list(run(iter([pd.Series([rows[9][1]])])))
    finally:
        decontamination.PatternSet = real
    assert len(built) == 1 and [list(x["n_hit"])[0] for x in out] == [60] * 5
    tracemalloc.start()
    held = real(rows, 13)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert held.searchers and peak < 250 * size  # 2 MB of items, a block, stay under 500 MB


def test_blocks_with_clashing_columns_nulls_and_repeats(spark):
    r = random.Random(9)
    items = [(i if i % 4 else None, prose(r, "abc", r.choice([0, 1, 2, 5, 30]), 2)) for i in range(60)] + [(7, None)] * 2
    docs = [(i, prose(r, "abc", r.randint(0, 60), 2)) for i in range(80)] + [(5, None), (5, ""), (5, "a b")] * 2
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4).select("*", F.lit(1).alias("_at"), F.lit(2).alias("spans"), F.lit(3).alias("block"))
    b = spark.createDataFrame(items, "item_id long, text string")
    one = decontamination.find_items(d, b)
    many = decontamination.find_items(d, b, block_bytes=200)
    assert one.columns == many.columns
    assert Counter(map(str, one.collect())) == Counter(map(str, many.collect()))


# --- extraction ------------------------------------------------------------------------------------------------------

def test_training_does_not_depend_on_row_order(spark):
    r = random.Random(1)
    rows = [(i, f"<nav>menu {i}</nav><article><h1>Title {i}</h1><p>{prose(r, 'abcdef', 30)}.</p></article>") for i in range(20)]
    rows += [(3, "<article><p>another page of that id.</p></article>"), (3, None), (None, "<p>x"), (4, rows[4][1])]
    weights = []
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "page_id long, html string").coalesce(1)
        weights.append(extraction.train(df, sample=8).p)
    assert all((weights[0][k] == weights[1][k]).all() for k in weights[0])


def test_a_long_page_among_short_ones_takes_memory_by_its_blocks():
    short = html_blocks.blocks("<p>a</p><p>b</p>")
    long = html_blocks.blocks("".join(f"<p>block {i}</p>" for i in range(20_000)))
    tracemalloc.start()
    out = extraction.Labeller().predict([short] * 255 + [long])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [len(x) for x in out] == [2] * 255 + [20_000] and peak < 100e6  # some 5 kB a block, 500 MB at 100,000


#: Page plans whose class and id names the training never uses: M marks main text, B boilerplate.
PLANS = [
    "<div class=topnav><a href=/>B home</a><a href=/b>B news</a></div><main><h1>M title</h1><p>M first words.</p><p>M second words.</p></main><div class=colophon>B all rights</div>",
    "<div id=wrap><ul class=toolbar><li><a href=/>B log in</a></ul><article><p>M one.</p><ul><li>M two</li></ul></article><div class=teasers><a href=/x>B read on</a></div></div>",
    "<section class=masthead>B the daily</section><article><h2>M head</h2><blockquote>M said so.</blockquote><p>M end.</p></article><section class=discuss><p>B I agree!</p><p>B me too</p></section>",
    "<main><p>M alpha.</p><aside class=boxout>B buy now</aside><p>M beta.</p></main><footer>B imprint</footer>",
    "<nav class=crumbs><a href=/>B top</a></nav><div class=leftcol><a href=/1>B one</a><a href=/2>B two</a></div><article class=piece><p>M text one.</p><p>M text two.</p></article>",
    "<header><h2>B site</h2></header><article><h1>M name</h1><p>M body of it.</p><table><tr><td>M cell</td></tr></table></article><form><label>B mail</label><button>B send</button></form>",
    "<div class=gdpr>B we use data</div><main><h1>M story</h1><p>M long ago.</p><p>M the end.</p></main><div class=recirc><ul><li><a href=/n>B next</a></li></ul></div>",
    "<article><p>M only text here.</p><div class=promo-box><a href=/buy>B offer</a></div><p>M and more.</p></article><footer class=site>B 2024</footer>",
]


def test_extraction_on_plans_with_other_names(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    model = extraction.train(pages)
    right = kept = main = 0
    for plan in PLANS:
        page = html_blocks.blocks(plan)
        chosen = [b.text for b, p in zip(page, model.predict([page])[0]) if p >= 0.5]
        right += sum(t.startswith("M ") for t in chosen)
        kept += len(chosen)
        main += sum(b.text.startswith("M ") for b in page)
    print(f"blocks: precision {right / kept:.3f} ({right} of {kept}), recall {right / main:.3f} ({right} of {main})")
    assert right / kept > 0.8 and right / main > 0.8


# --- toxicity, quality, checkpoints ------------------------------------------------------------------------------------

def test_counterfactual_pairs_and_neutral_mentions(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.train(docs, labels)
    assert model.swap_pairs > 1000
    clean = docs.join(labels.filter("toxic = 0"), "doc_id").filter("crc32(cast(doc_id as string)) % 3 = 1").limit(300)
    plain = Counter(x.predicted for x in toxicity.score(clean, model).collect())
    for mention in (" The women and the muslims spoke.", " Die juden und die frauen sprachen.", " Los musulmanes y las mujeres hablaron."):
        told = clean.withColumn("text", F.concat("text", F.lit(mention)))
        assert Counter(x.predicted for x in toxicity.score(told, model).collect()) == plain


def test_fit_reaches_the_least_loss_of_another_solver():
    r = random.Random(4)
    rows = []
    for i in range(200):
        words = {f"w{r.randrange(12)}" for _ in range(4)} | ({"women"} if r.random() < (0.6 if i % 2 else 0.1) else set())
        rows.append((sorted(words), toxicity.swaps(" ".join(words)), i % 2, 1.0))
    l1, cf = 1e-3, 0.05
    pairs = sum((x[1] for x in rows), Counter())
    vocabulary = sorted({w for x in rows for w in x[0]} | {t for p in pairs for t in p} - toxicity.NEUTRAL)
    at = {w: i for i, w in enumerate(vocabulary)}
    x = np.zeros((len(rows), len(vocabulary)))
    for i, row in enumerate(rows):
        x[i, [at[w] for w in row[0]]] = 1
    y = np.array([row[2] for row in rows], float)
    often = sum(pairs.values())

    def loss(w, b):
        z = x @ w + b
        swap = sum(n / often * (w[at[s]] - (w[at[t]] if t in at else 0.0)) ** 2 for (s, t), n in pairs.items())
        return float(np.mean(np.logaddexp(0, z) - y * z) + l1 * np.abs(w).sum() + cf * swap)

    model = toxicity.fit(rows, l1=l1, cf=cf, steps=4000)
    w = np.array([model.weights.get(v, 0.0) for v in vocabulary])
    best = loss(w, model.bias)
    u, b, r_ = np.zeros(len(vocabulary)), 0.0, np.random.default_rng(1)
    for size in (0.5, 0.1, 0.02, 0.005):  # coordinate search, sharing nothing with the fit
        for _ in range(25):
            for i in r_.permutation(len(u)):
                for step in (size, -size):
                    v = u.copy()
                    v[i] += step
                    if loss(v, b) < loss(u, b):
                        u = v
            for step in (size, -size):
                if loss(u, b + step) < loss(u, b):
                    b += step
    assert best <= loss(u, b) + 1e-4


def test_the_given_strata_prove_cutoffs(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    out = quality.quality(docs, labels, keep=["doc_id", "lang"], risk=quality.RISK)
    lost = out.join(labels, "doc_id").filter("NOT base_failed").groupBy("lang", "quality").agg(F.count("*").alias("n"), F.count_if(~F.col("kept")).alias("gone"))
    by = {(x.lang, x.quality): x.gone / x.n for x in lost.collect()}
    for lang in ("de", "en", "es", "fr"):
        assert by[lang, 0] > 0.5 and by[lang, 1] <= 4 * quality.RISK


def test_released_cuts_leave_no_files(spark):
    fs = spark._jvm.org.apache.hadoop.fs.FileSystem.get(spark._jsc.hadoopConfiguration())
    before = common.cuts()
    common.cut(spark.range(10))
    path = common._CUTS[-1]
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    assert fs.exists(where)
    common.release(spark, before)
    assert not fs.exists(where) and common.cuts() == before
