"""Each operator against a brute-force version, an exact round trip or held-out accuracy."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import chat, decontamination, extraction, html_blocks, language, mixing, quality, sharding, simhash, toxicity


def test_mix_meets_targets_and_caps(spark):
    r = random.Random(3)
    rows = [(i, " ".join(["w"] * r.randint(0, 40)), r.choice(["big"] * 12 + ["b", "c", "d", None])) for i in range(900)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    sizes, taken, target = {}, {}, {}
    for x in out:
        sizes[x.source] = sizes.get(x.source, 0) + x["size"]
        taken[x.source] = taken.get(x.source, 0) + x.taken
        target[x.source] = x.target
        assert 0 <= x.taken <= 3 * x["size"]
    names = sorted((s for s in sizes if s), key=str) + [None]
    weight = {s: [1, 2, 3][i % 3] for i, s in enumerate(names)}
    free, left, expected = set(names), float(sum(sizes.values())), {}
    while True:  # the contract's rounds: share by weight, stop at three times the size, share the excess again
        share = {s: left * weight[s] / sum(weight[t] for t in free) for s in free}
        full = {s for s in free if share[s] > 3 * sizes[s]}
        if not full:
            expected.update(share)
            break
        expected.update({s: 3.0 * sizes[s] for s in full})
        left -= sum(3 * sizes[s] for s in full)
        free -= full
    for s in names:
        assert target[s] == pytest.approx(expected[s]) and taken[s] == math.floor(target[s] + 1e-9)


def test_binomial_bound_is_exact(spark):
    cases = [(n, k) for n in (20, 300, 5000) for k in (0, 1, 3, 17) if k < n * 0.1]
    df = spark.createDataFrame(cases, "n long, k long").select("n", "k", F.expr(quality._CDF.format(p="0.1D")).alias("p"))
    for x in df.collect():
        exact = sum(math.comb(x.n, j) * 0.1 ** j * 0.9 ** (x.n - j) for j in range(x.k + 1)) if x.n < 1000 else None
        if exact is not None:
            assert x.p == pytest.approx(exact, rel=1e-9)
        assert 0 <= x.p <= 1


def test_quality_counts_and_controlled_rejection(spark):
    r = random.Random(5)

    def text(good):
        words = [r.choice("abcdefghij") * r.randint(1, 6) + str(r.randint(0, 99)) for _ in range(r.randint(15, 80))]
        if not good:
            words = [w + "###" for w in words]
        if good and r.random() < 0.4:
            words += words[:9]
        return " ".join(words[:10]) + "\n" + " ".join(words[10:]) + ("\n" + " ".join(words[:10]) if r.random() < 0.3 else "")

    rows = [(i, text(i % 5 > 0), "en") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 5 > 0)) for i in range(4000)], "doc_id long, quality int")
    out = {x.doc_id: x for x in quality.quality(docs, labels).collect()}
    for i, t, _ in rows[:200]:
        w, lines = t.split(), [x for x in t.split("\n") if x.strip()]
        grams = [tuple(w[j:j + 5]) for j in range(len(w) - 4)]
        covered = {p for j, g in enumerate(grams) if grams.count(g) > 1 for p in range(j, j + 5)}
        x = out[i]
        assert (x.n_words, x.n_repeat_words, x.n_dup_lines) == (len(w), len(covered), len(lines) - len(set(lines)))
        assert x.word_chars == sum(map(len, w)) and x.n_symbols == sum(c in "#*$%&|<>" for c in t)
    good = [out[i] for i, *_ in rows if i % 5 > 0 and not out[i].base_failed]
    bad = [out[i] for i, *_ in rows if i % 5 == 0 and not out[i].base_failed]
    assert sum(not x.kept for x in good) <= 4 * 0.004 * len(good) and not any(x.kept for x in bad)
    none = spark.createDataFrame([(1, 1)], "doc_id long, quality int")  # too few labels: nothing is proven
    assert all(x.kept != x.base_failed for x in quality.quality(docs.limit(100), none).collect())


@pytest.mark.parametrize("good, risk, proven", [(300, 0.02, True), (300, 0.004, False), (280, 0.02, False)])
def test_quality_small_stratum(spark, good, risk, proven):
    """Four strata: 16 tests need 286 good labels at a risk of 0.02 and 1,440 at 0.004."""
    rows = [(f"{lang}{i}", " ".join(f"w{j}" + "#" * (i >= good) for j in range(12)), lang)
            for lang in ("de", "en", "es", "fr") for i in range(good + 5)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, lang string")
    labels = spark.createDataFrame([(i, int("#" not in t)) for i, t, _ in rows], "doc_id string, quality int")
    out = quality.quality(docs, labels, risk=risk).groupBy("lang").agg(F.count_if(~F.col("kept")).alias("n")).collect()
    assert {x.lang: x.n for x in out} == dict.fromkeys(("de", "en", "es", "fr"), 5 if proven else 0)


def naive_phrases(text, sample):
    count, at = 0, 0
    while at < len(text):
        end = at + 1
        while end < len(text) and text[at:end + 1] in sample:
            end += 1
        count, at = count + 1, end
    return count


def test_cross_parsing_counts():
    r = random.Random(1)
    samples = {x: " " + " ".join("".join(r.choice(a) for _ in range(r.randint(1, 6))) for _ in range(80)) + " "
               for x, a in (("aa", "abcde"), ("bb", "cdefgh"))}
    parser = language.Parser(samples)
    texts = [" " + " ".join("".join(r.choice("abcdefghxy") for _ in range(5)) for _ in range(n)) + " " for n in (1, 4, 60)]
    got = parser.phrases([parser.encode(t) for t in texts], 1 << 20)
    # The last phrase of a text is open: a step that fails starts the next phrase, so counts are breaks + 1.
    assert got.tolist() == [[naive_phrases(t, samples[n]) for n in parser.names] for t in texts]


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = language.identify(docs, language.learn(docs)).filter("held_out")
    right = out.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.97


def test_samples_hold_one_text_an_id(spark, monkeypatch):
    rows = [(8, f"same id again {i} times", "en") for i in range(2000)] + [(i, f"text number {i}", "en") for i in range(9, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    read, fitted = [], []
    monkeypatch.setattr(language, "letters_of", lambda t, plain=language.letters_of: read.append(t) or plain(t))
    monkeypatch.setattr(toxicity, "fit", lambda x, plain=toxicity.fit, **o: fitted.extend(x) or plain(x, **o))
    taken = [i for i in range(8, 60) if zlib.crc32(str(i).encode()) % 4 != 2]
    assert 8 in taken and language.learn(docs)["en"]
    assert len(read) == len(taken) and sum(t.startswith("same") for t in read) == 1
    language.learn(docs, per_language=20)
    assert len(read) == len(taken) + 20  # repeats take no places
    labels = spark.createDataFrame([(i, i % 2) for i in range(8, 60)], "doc_id long, toxic int")
    toxicity.train(docs, labels)
    assert zlib.crc32(b"8") % 3 != 1 and len(fitted) == sum(zlib.crc32(str(i).encode()) % 3 != 1 for i in range(8, 60))


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=3))
def test_every_near_pair_collides(value, flips):
    other = value
    for f in flips:
        other ^= 1 << f
    masks = simhash.covering_masks(list(range(64)), 3)
    assert any(value & m == other & m for m in masks)
    mask = next(m for m in masks if value & m == other & m)
    inner = simhash.covering_masks([p for p in range(64) if not mask >> p & 1], 3)
    assert any(value & m == other & m for m in inner)


def brute_components(values):
    group = {v: v for v in values}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x
    vs = sorted(values)
    for i, a in enumerate(vs):
        for b in vs[:i]:
            if (a ^ b).bit_count() <= 3:
                group[find(a)] = find(b)
    return {v: find(v) for v in vs}


@pytest.mark.parametrize("direct", [4, 4096])
def test_groups_match_brute_force(spark, direct):
    r = random.Random(9)
    values = set()
    for _ in range(12):
        x = r.getrandbits(64)
        values.add(x)
        for _ in range(25):  # chains of near copies
            for _ in range(r.randint(1, 3)):
                x ^= 1 << r.randrange(64)
            values.add(x)
    values = sorted(values)
    marks = spark.createDataFrame([(i, simhash.signed(v)) for i, v in enumerate(values)], "id long, fp long")
    got = {x.fp: x.component_id for x in simhash.groups(marks, direct=direct).collect()}
    expected = brute_components(values)
    low = {}
    for i, v in enumerate(values):
        low[expected[v]] = min(low.get(expected[v], i), i)
    assert got == {simhash.signed(v): low[expected[v]] for v in values}


def test_fingerprint_majority():
    from xxhash import xxh64_intdigest
    for text in ("Aa b C d e", "one two", "x", "a b c a b c a b c", "é ü ñ ß"):
        w = text.encode().lower().split()
        grams = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
        h = [xxh64_intdigest(g, 42) for g in grams]
        expected = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
        assert simhash.fingerprint(text.encode()) == expected


def test_swaps_pull_identity_terms_to_neutral():
    r = random.Random(2)
    words = [f"w{i}" for i in range(60)]

    def row(toxic):
        t = " ".join(r.choice(words) for _ in range(12))
        if toxic:
            t += " vile" if r.random() < 0.7 else ""
            t += " women" if r.random() < 0.8 else " men"  # identity terms merely co-occur
        elif r.random() < 0.1:
            t += " women"
        return toxicity.features(t), toxicity.swaps(t), toxic, 1.0

    rows = [row(i % 2) for i in range(600)]
    plain, fair = toxicity.fit(rows, cf=0.0), toxicity.fit(rows, cf=5.0)
    gap = [abs(m.weights.get("women", 0) - m.weights.get("people", 0)) for m in (plain, fair)]
    assert gap[1] < 0.2 * gap[0]
    assert fair.score("the women spoke") < plain.score("the women spoke")


def test_toxicity_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = toxicity.score(docs, toxicity.train(docs, labels)).filter("held_out").join(labels, "doc_id")
    c = {(x.toxic, x.predicted): x["count"] for x in held.groupBy("toxic", "predicted").count().collect()}
    assert c[(1, 1)] / (c[(1, 1)] + c.get((1, 0), 0)) > 0.75
    assert c.get((0, 1), 0) / (c[(0, 0)] + c.get((0, 1), 0)) < 0.01


def test_lstm_gradient():
    model = extraction.Labeller()
    r = np.random.default_rng(0)
    pages = [(r.normal(size=(n, extraction.INPUT)), r.integers(0, 2, n).astype(float)) for n in (1, 3, 4)]
    model.p["own"] = r.normal(0, 0.1, extraction.INPUT)

    def loss():
        total, count = 0.0, sum(len(y) for _, y in pages)
        steps, size = 4, 3
        x, mask = np.zeros((steps, size, extraction.INPUT)), np.zeros((steps, size), bool)
        for i, (a, y) in enumerate(pages):
            x[:len(y), i], mask[:len(y), i] = a, True
        h = {d: model._run(x @ model.p[f"x{d}"] + model.p[f"c{d}"], mask, d, False)[0] for d in "fb"}
        z = (h["f"] @ model.p["out"][:extraction.HIDDEN] + h["b"] @ model.p["out"][extraction.HIDDEN:]
             + x @ model.p["own"] + model.p["bias"])
        for i, (_, y) in enumerate(pages):
            p = extraction.sigmoid(z[:len(y), i])
            total -= (y * np.log(p) + (1 - y) * np.log(1 - p)).sum()
        return total / count

    grads = model._gradient(pages)
    for k in ("xf", "hb", "cf", "out", "bias"):
        at = tuple(r.integers(0, n) for n in model.p[k].shape)
        old, e = model.p[k][at], 1e-5
        model.p[k][at] = old + e
        up = loss()
        model.p[k][at] = old - e
        down = loss()
        model.p[k][at] = old
        assert grads[k][at] == pytest.approx((up - down) / (2 * e), rel=1e-3, abs=1e-7), k


def test_labeller_reads_unseen_plans():
    r = random.Random(99)
    good = ["Some plain text of an article.", "Another sentence with more words in it.", "A third one."]
    model = extraction.fit([], plans=300)
    right = total = 0
    for _ in range(100):
        page = html_blocks.blocks(extraction.rearranged(r, good, ["menu", "share this", "all rights"]))
        p = model.predict([page])[0]
        right += sum(int(q >= 0.5) == (b.mark or 0) for q, b in zip(p, page))
        total += len(page)
    assert right / total > 0.97


def test_blocks_of_broken_markup():
    page = ("<title>T</title><style>p{}</style><script>var t='</p>';</script><p>a  b<br>c &amp;amp; d<p>e<!-- x --> f"
            "<ul><li>g<li>h<a href='>'>i</a></ul><div class=\"x")
    assert [b.text for b in html_blocks.blocks(page)] == ["T", "a b", "c &amp; d", "e f", "g", "hi"]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<|>s/[]INT\\nt\n_:o", max_size=40), st.text(alphabet="<|>us\\n\n", max_size=8))
def test_escaping_round_trip(text, role):
    f = chat.format_turns([(role, [{"type": "text", "text": text}]), ("assistant", [{"type": "text", "text": text}])])
    assert chat.read_back(f.text) == [(role, text), ("assistant", text)]
    assert not any(c in chat.escape(text) for c in chat.CONTROL)
    both = text + text if role == "assistant" else text
    assert chat.read_loss(f.text, f.loss) == both


def test_parts_and_attachments(spark):
    parts = [{"type": "text", "text": "see "}, {"type": "image", "ref": "s3://b/i.png", "width": 100, "height": 56},
             {"type": "text", "text": " and <|image:0|>"}, {"type": "audio", "ref": "a.wav", "seconds": 2.5},
             {"type": "document", "ref": "d.pdf", "pages": 3}]
    f = chat.format_turns([("user", parts)])
    assert [(a["kind"], a["number"], a["ref"], a["tokens"]) for a in f.attachments] == [
        ("image", 0, "s3://b/i.png", 8), ("audio", 0, "a.wav", 63), ("document", 0, "d.pdf", 1536)]
    assert all(f.text[a["at"]:].startswith(f"<|{a['kind']}:") for a in f.attachments)
    assert chat.read_back(f.text) == [("user", "see  and <|image:0|>")]
    rows = spark.createDataFrame([(1, 0, "user", None, [("image", None, "r")]), (1, 1, "assistant", "hi", None)],
                                 "conv_id long, turn long, role string, text string, parts array<struct<type: string, text: string, ref: string>>")
    out = chat.format_conversations(rows, parts_col="parts").first()
    assert out.attachments[0].ref == "r" and chat.read_loss(out.formatted, [(s.first, s.last) for s in out.loss]) == "hi"


@pytest.mark.parametrize("n", [1, 2, 5, 41, 1000])
def test_permutation_is_a_bijection(spark, n):
    walk = sharding.longest_walk(spark, n, 7)
    got = [r.p for r in spark.range(n).select(F.expr(sharding.permuted("id", n, 7, walk)).alias("p")).collect()]
    assert sorted(got) == list(range(n))

    def once(y):
        a, b = sharding.halves(n)
        x, z = divmod(y, b)
        for i, (p, q, m) in enumerate(sharding.round_keys(7)):
            def mixed(h):
                return (((h + p) * (h + q) % sharding.PRIME) * m + p) % sharding.PRIME
            x, z = ((x + mixed(z)) % a, z) if i % 2 == 0 else (x, (z + mixed(x)) % b)
        return x * b + z

    for i in range(n):  # the place is computable from the number alone
        y = once(i)
        while y >= n:
            y = once(y)
        assert y == got[i]


def test_shards_are_even_and_gapless(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    import zlib
    rows = sharding.shard(docs, shards=7).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
        assert r["size"] == len(texts[r.doc_id].encode()) + 16 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    again = {(r.doc_id, r.shard, r.slot) for r in sharding.shard(docs.repartition(5), shards=7).collect()}
    assert again == {(r.doc_id, r.shard, r.slot) for r in rows}


@pytest.mark.parametrize("hot_id", [5, None])
def test_repeats_of_one_row_are_dealt_over_tasks(spark, hot_id):
    r = random.Random(4)
    rows = [(i, " ".join(["w"] * r.randint(0, 30)), "a" if i % 3 else None) for i in range(1, 20_001)]
    rows += [(hot_id, "one hot row", "a")] * 12_000
    r.shuffle(rows)
    docs = spark.sparkContext.parallelize(rows, 8).toDF("doc_id long, text string, source string")
    plain = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in plain}
    for k, v in plain.items():  # tasks as they are on a large table
        spark.conf.set(k, v)
    try:
        for carry in (True, False):
            out = mixing.mix(docs, carry=carry).withColumn("task", F.spark_partition_id()).collect()
            tasks = Counter(x.task for x in out if x.doc_id == hot_id and x["size"] == 3)
            assert len(out) == 32_000 and sum(tasks.values()) >= 12_000 and max(tasks.values()) < 6_000
            taken, target, order = {}, {}, {}
            for x in out:  # the stream of each source, in key order
                key = hashlib.md5((f"{x.doc_id}:" if x.doc_id is not None else "").encode() + str(x["size"]).encode()).hexdigest()
                s = x.source_size
                taken[s], target[s] = taken.get(s, 0) + x.taken, x.target
                order.setdefault(s, []).append((key, -1 if x.doc_id is None else x.doc_id, x["size"], x.taken))
            for s, stream in order.items():
                assert taken[s] == math.floor(target[s] + 1e-9)
                epochs, left = divmod(taken[s], s)
                expected = []
                for *at, n, _ in sorted(stream):
                    expected.append((*at, n, n * epochs + max(0, min(n, left))))
                    left -= n
                assert sorted(stream) == sorted(expected)
        placed = sharding.shard(docs, shards=7).withColumn("task", F.spark_partition_id()).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    tasks = Counter(x.task for x in placed if x.doc_id == hot_id and x.text == "one hot row")
    assert sum(tasks.values()) == 12_000 and max(tasks.values()) < 6_000
    assert sorted(x.slot * 7 + x.shard for x in placed) == list(range(32_000))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="abc ", max_size=60), min_size=1, max_size=5), st.text(alphabet="abc ", max_size=120), st.integers(1, 5))
def test_wu_manber_matches_brute_force(items, text, window):
    rows = [(str(i), t) for i, t in enumerate(items)]
    spans, found = decontamination.PatternSet(rows, window).search(decontamination.words(text))
    w, hit, of = decontamination.words(text), set(), set()
    for i, t in rows:
        p = decontamination.words(t)
        m = min(window, len(p))
        for a in range(len(p) - m + 1 if m else 0):
            for b in range(len(w) - m + 1):
                if w[b:b + m] == p[a:a + m]:
                    hit |= set(range(b, b + m))
                    of.add(i)
    assert found == of and {p for a, b in decontamination.merged(spans) for p in range(a, b)} == hit


def test_item_blocks_give_equal_results(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    cols = ["doc_id", "n_hit", "spans", "items"]
    one = decontamination.find_items(docs, items).select(cols)
    many = decontamination.find_items(docs, items, block_bytes=2000).select(cols)
    assert one.exceptAll(many).count() == 0 and one.filter("n_hit > 0").count() > 0
