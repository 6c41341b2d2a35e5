"""Every row that the corpus pipeline returns, against its five stages in plain Python."""

import hashlib
import math
import random
import zlib
from collections import Counter

from xxhash import xxh64_intdigest

import corpus_pipeline
from tidemark.llm import sharding, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def fixture():
    r = random.Random(11)
    vocabulary = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(3, 8))) for _ in range(400)]

    def prose(n):
        return [r.choice(vocabulary) for _ in range(n)]

    items = [(1, " ".join(prose(30))), (2, "Short Item here"), (None, " ".join(prose(20))), (3, None), (4, "")]
    rows, labels = [], []
    for i in range(260):
        words = prose(r.choice([2, 12, 40, 150]))
        if i % 5 == 0:  # toxic; every second one labelled
            words[r.randrange(len(words)):0] = ["zzvile", "zzscum"]
        if i % 13 == 1:  # contaminated, by items with and without id
            words[1:1] = items[r.choice((0, 1, 2))][1].upper().split()
        if i % 5 != 0 or i % 2 == 0:
            labels.append((i, None, int(i % 5 == 0)))
        rows.append((i if i % 29 else None, " ".join(words), r.choice(["en", "de"]), r.choice(["a"] * 8 + ["b", "c", None]), len(words)))
    for i in range(300, 330):  # near copies of one long text, and another text's exact copies under other ids
        long = [vocabulary[k * k % 97] for k in range(900)] if i == 300 else long
        rows.append((i, " ".join([*long, f"tail{i}"]), "en", "a", i))
        rows.append((i + 100, rows[12][1], "de", "b", i))
    rows += [rows[7]] * 20 + [rows[29]] * 5  # repeats, with and without an id
    rows += [(500, None, "en", "a", None), (501, "", None, None, 0), (None, " \n", "en", "b", 2), (None, None, None, None, None)]
    labels += [(None, 1, 1), (3, None, None), (9_999, 0, 1), (8, None, 0)]
    r.shuffle(rows)
    return rows, labels, items


def accepted(rows, labels):
    known = {}
    for i, _, y in labels:
        if i is not None and y in (0, 1) and zlib.crc32(str(i).encode()) % 3 != 1:
            known[i] = max(y, known.get(i, 0))
    count = Counter(known.values())
    texts = {(text, known[i]) for i, text, *_ in rows if i in known}
    used = Counter(y for _, y in texts)
    has = {y: Counter(w for t, of in texts if of == y for w in toxicity.features(t)) for y in (0, 1)}
    entering = set(toxicity.IDENTITY - toxicity.NEUTRAL)
    for w in has[0].keys() | has[1].keys():
        a, b, n = has[0][w], has[1][w], used[0] + used[1]
        error = math.sqrt((a + b) / n * (1 - (a + b) / n) * (1 / used[0] + 1 / used[1]))
        if a + b >= 3 and error > 0 and abs(b / used[1] - a / used[0]) >= 4.5 * error:
            entering.add(w)
    model = toxicity.fit([(sorted(toxicity.features(t) & entering), toxicity.swaps(t), y, count[y] / used[y])
                          for t, y in sorted(texts, key=str)])
    return [x for x in rows if model.score(x[1]) < 0.7]


def text_hash(text):
    h = 42 if text is None else xxh64_intdigest(text.encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def fingerprint(text):
    words = text.encode().lower().split() if text else []
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << p for p in range(64) if 2 * sum(h >> p & 1 for h in hashes) > len(hashes))


def one_of_each(rows):
    marks = [fingerprint(x[1]) for x in rows]
    group = {}
    for seed in set(marks):
        todo = [] if seed in group else [seed]
        while todo:
            at = todo.pop()
            group[at] = seed
            todo += [m for m in set(marks) if m not in group and (m ^ at).bit_count() <= 3]
    members = {}
    for x, m in zip(rows, marks):
        members.setdefault(group[m], []).append(x)
    return [min(g, key=lambda x: (x[0] is None, x[0] or 0, text_hash(x[1]))) for g in members.values()]


def clean(rows, items):
    def words(text):
        return "".join(c.lower() if c.isascii() and c.isalnum() else c if not c.isascii() else " " for c in text or "").split()

    patterns = set()
    for _, text in items:
        w = words(text)
        m = min(13, len(w))
        patterns |= {tuple(w[i:i + m]) for i in range(len(w) - m + 1) if m}
    out = []
    for x in rows:
        w = words(x[1])
        hit = {p for m in {len(p) for p in patterns} for i in range(len(w) - m + 1) if tuple(w[i:i + m]) in patterns
               for p in range(i, i + m)}
        if not hit or 20 * len(hit) < len(w):
            out.append(x)
    return out


def mixed(rows):
    size = {}
    for _, text, _, source, _ in rows:
        size[source] = size.get(source, 0) + len((text or "").split())
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    free, left, target = set(names), float(sum(size.values())), {}
    while free:  # share by weight, stop at three times the size, share the excess again
        share = {s: left * weight[s] / sum(weight[t] for t in free) for s in free}
        full = {s for s in free if share[s] > 3 * size[s]}
        target.update({s: 3.0 * size[s] if s in full else share[s] for s in (full or free)})
        left -= sum(3 * size[s] for s in full)
        free = free - full if full else set()
    out = []
    for s in names:
        epochs, rest = divmod(math.floor(target[s] + 1e-9), size[s]) if size[s] else (0, 0)

        def order(x):
            n = len((x[1] or "").split())
            key = str(n) if x[0] is None else f"{x[0]}:{n}"
            return hashlib.md5(key.encode()).hexdigest(), -1 if x[0] is None else x[0], n

        for x in sorted((x for x in rows if x[3] == s), key=order):
            n = len((x[1] or "").split())
            out += [x] * (epochs + int(rest > 0 and 2 * min(n, rest) >= n))
            rest -= n
    return out


def sharded(rows, shards=40, seed=20_240_601):
    n = len(rows)
    a, b = sharding.halves(n)

    def once(y):
        x, z = divmod(y, b)
        for i, (p, q, m) in enumerate(sharding.round_keys(seed)):
            def f(h):
                return (((h + p) * (h + q) % sharding.PRIME) * m + p) % sharding.PRIME
            x, z = ((x + f(z)) % a, z) if i % 2 == 0 else (x, (z + f(x)) % b)
        return x * b + z

    def order(x):
        text = (x[1] or "").encode()
        crc = zlib.crc32(text)
        key = str(crc) if x[0] is None else f"{x[0]}:{crc}"
        return hashlib.md5(key.encode()).hexdigest(), -1 if x[0] is None else x[0], len(text) + 16, crc

    out = []
    for i, x in enumerate(sorted(rows, key=order)):
        y = once(i)
        while y >= n:
            y = once(y)
        out.append((*x, len((x[1] or "").encode()) + 16, zlib.crc32((x[1] or "").encode()), "rows", y % shards, y // shards, None))
    return out


def test_every_row_of_the_pipeline(spark, tmp):
    rows, labels, items = fixture()
    spark.createDataFrame(rows, DOCS).repartition(5).write.parquet(f"{tmp}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp}/benchmark.parquet")
    stages = [rows, accepted(rows, labels)]
    stages.append(one_of_each(stages[-1]))
    stages.append(clean(stages[-1], items))
    stages.append(mixed(stages[-1]))
    sizes = [len(s) for s in stages]
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] and set(stages[4]) < set(stages[3]) and sizes[4] > len(set(stages[4]))
    docs = spark.read.parquet(f"{tmp}/documents.parquet")
    for (name, stage), expected in zip(corpus_pipeline.STAGES, stages[1:]):  # each stage on what plain Python kept before it
        assert Counter(map(tuple, stage(spark, docs, tmp).collect())) == Counter(expected), name
        docs = spark.createDataFrame(expected, DOCS)
    got = corpus_pipeline.run(spark, tmp).select(*docs.columns, "size", "text_crc32", "law", "shard", "slot", "grown_shard")
    assert Counter(map(tuple, got.collect())) == Counter(sharded(stages[4]))
