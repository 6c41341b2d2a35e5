"""Main-text extraction with a recurrent block labeller.

A page becomes its sequence of leaf blocks. Every block is a vector: the tokens
of its tag path and the words of its whole text, both hashed, with its length,
link share and place. A bidirectional LSTM in numpy reads the sequence in both
directions, so each block is judged in the context of the whole page, and the
blocks it accepts are the main text.

Training needs no given labels. Pages whose markup says what is what (``article``
or ``main`` against navigation, advert, footer and similar names) teach the
network, together with rearrangements of the same pages' texts into other page
plans, where notices, forms, sidebars, related links and reader comments
surround and interrupt the article under many names. At most ``sample`` pages
take part; the fitted weights (some 60 kB) are all that is broadcast.

Defined results: null, empty and blank pages have an empty text; unclosed and
truncated markup is read as far as it goes; repeated rows get equal texts; an
empty table gives no rows.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import nest, table, unnest
from .html_blocks import Block, blocks

PATH, WORDS, NUMBERS, HIDDEN = 256, 24, 5, 12
INPUT = PATH + WORDS + NUMBERS

#: Names that mark boilerplate and main text where pages use them; fixed values.
BOILERPLATE_TAGS = ("nav", "header", "footer", "aside", "form", "button", "select", "textarea", "title", "head",
                    "noscript", "iframe", "menu", "dialog", "fieldset", "label")
BOILERPLATE_NAMES = ("ad", "ads", "advert", "banner", "sponsored", "promo", "cookie", "cookie-banner", "consent", "notice",
                     "sidebar", "related", "share", "social", "newsletter", "subscribe", "breadcrumb", "pagination", "menu",
                     "nav", "footer", "header", "comment", "comments", "comment-list", "reply", "popup", "modal", "widget",
                     "site-header", "site-footer", "login", "search", "copyright", "legal", "tags", "author-box")
MAIN_TAGS = ("article", "main")
MAIN_NAMES = ("content", "main-content", "post", "post-body", "entry-content", "article-body", "story", "text", "body-text")


def place(token: str) -> int:
    return zlib.crc32(token.encode()) % PATH


def dense(page: list[Block]) -> np.ndarray:
    """Hashed words and numbers of every block of a page."""
    out = np.zeros((len(page), WORDS + NUMBERS), np.float32)
    for i, b in enumerate(page):
        data = b.text.encode()
        words = data.lower().split()
        counts = np.bincount(np.fromiter((zlib.crc32(w) % WORDS for w in words), np.int64, len(words)), minlength=WORDS)
        out[i, :WORDS] = counts / max(1.0, float(np.sqrt((counts * counts).sum())))
        out[i, WORDS:] = (np.log1p(len(data)) / 8, b.link_share, i / len(page), np.log1p(len(page)) / 6,
                          data.endswith((b".", b"!", b"?")))
    return out


def path_vector(tokens: frozenset) -> np.ndarray:
    v = np.zeros(PATH, np.float32)
    v[[place(t) for t in tokens]] = 1
    return v


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Bidirectional LSTM over block vectors with a logistic output that also sees the block itself."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        self.p = {"out": r.normal(0, 0.1, 2 * HIDDEN), "own": np.zeros(INPUT), "bias": np.zeros(1)}
        for d in "fb":
            self.p[f"x{d}"] = r.normal(0, 0.08, (INPUT, 4 * HIDDEN))
            self.p[f"h{d}"] = r.normal(0, 0.15, (HIDDEN, 4 * HIDDEN))
            self.p[f"c{d}"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])

    def _run(self, gates: np.ndarray, mask: np.ndarray, d: str, keep: bool):
        """Hidden states (T, B, H) for input gates (T, B, 4H), backwards for direction b."""
        steps = range(len(gates)) if d == "f" else range(len(gates) - 1, -1, -1)
        size = gates.shape[1]
        h, c = np.zeros((size, HIDDEN), gates.dtype), np.zeros((size, HIDDEN), gates.dtype)
        out, trace = np.zeros((*gates.shape[:2], HIDDEN), gates.dtype), []
        for t in steps:
            a = gates[t] + h @ self.p[f"h{d}"]
            s = sigmoid(a[:, :3 * HIDDEN])
            i, f, o, g = s[:, :HIDDEN], s[:, HIDDEN:2 * HIDDEN], s[:, 2 * HIDDEN:], np.tanh(a[:, 3 * HIDDEN:])
            live = mask[t][:, None]
            new_c = np.where(live, f * c + i * g, c)
            tc = np.tanh(new_c)
            new_h = np.where(live, o * tc, h)
            if keep:
                trace.append((t, h, c, i, f, o, g, tc, live))
            h, c = new_h, new_c
            out[t] = h
        return out, trace

    def train(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = 14, batch: int = 16, rate: float = 0.01,
              seed: int = 11) -> None:
        """Adam on the log loss; ``pages``: (block vectors, labels)."""
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        step = 0
        for _ in range(epochs):
            order = sorted(r.permutation(len(pages)), key=lambda i: len(pages[i][1]))
            starts = r.permutation(range(0, len(order), batch))
            for s in starts:
                grads = self._gradient([pages[i] for i in order[s:s + batch]])
                step += 1
                for k, g in grads.items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.p[k] -= rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
        self.p = {k: x.astype(np.float32) for k, x in self.p.items()}

    def _gradient(self, pages) -> dict[str, np.ndarray]:
        steps, size = max(len(y) for _, y in pages), len(pages)
        x, y, mask = np.zeros((steps, size, INPUT)), np.zeros((steps, size)), np.zeros((steps, size), bool)
        for i, (a, b) in enumerate(pages):
            x[:len(b), i], y[:len(b), i], mask[:len(b), i] = a, b, True
        hidden, traces = {}, {}
        for d in "fb":
            hidden[d], traces[d] = self._run(x @ self.p[f"x{d}"] + self.p[f"c{d}"], mask, d, True)
        z = (hidden["f"] @ self.p["out"][:HIDDEN] + hidden["b"] @ self.p["out"][HIDDEN:] + x @ self.p["own"] + self.p["bias"])
        dz = (sigmoid(z) - y) * mask / mask.sum()
        grads = {"bias": np.array([dz.sum()]), "own": np.einsum("tb,tbi->i", dz, x) + 1e-4 * self.p["own"],
                 "out": np.concatenate([np.einsum("tb,tbh->h", dz, hidden[d]) for d in "fb"])}
        for k, d in enumerate("fb"):
            above = dz[:, :, None] * self.p["out"][k * HIDDEN:(k + 1) * HIDDEN]
            dgates = np.zeros((steps, size, 4 * HIDDEN))
            dh, dc = np.zeros((size, HIDDEN)), np.zeros((size, HIDDEN))
            gh = np.zeros_like(self.p[f"h{d}"])
            for t, h, c, i, f, o, g, tc, live in reversed(traces[d]):
                dh = dh + above[t]
                dct = dc + np.where(live, dh * o * (1 - tc * tc), 0)
                da = np.concatenate([dct * g * i * (1 - i), dct * c * f * (1 - f), dh * tc * o * (1 - o),
                                     dct * i * (1 - g * g)], 1) * live
                dgates[t] = da
                gh += h.T @ da
                dh = np.where(live, da @ self.p[f"h{d}"].T, dh)
                dc = np.where(live, dct * f, dc)
            grads[f"h{d}"] = gh
            grads[f"x{d}"] = np.einsum("tbi,tbg->ig", x, dgates)
            grads[f"c{d}"] = dgates.sum((0, 1))
        return grads

    def predict(self, pages: list[list[Block]], cells: int = 1 << 16) -> list[np.ndarray]:
        """Probability of main text for each block of each page.

        Pages run side by side, padded to the longest of their group; a group has at
        most ``cells`` places unless one page alone has more.
        """
        paths: dict[frozenset, int] = {}
        ids = [np.array([paths.setdefault(b.tokens, len(paths)) for b in page], np.int64) for page in pages]
        vectors = np.stack([path_vector(t) for t in paths]) if paths else np.zeros((0, PATH), np.float32)
        of_path = {k: vectors @ self.p[k][:PATH] for k in ("xf", "xb", "own")}
        out: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i]))
        groups: list[list[int]] = []
        for i in order:  # by length, so the latest page is the longest
            if not groups or (len(groups[-1]) + 1) * len(pages[i]) > cells:
                groups.append([])
            groups[-1].append(i)
        for group in groups:
            steps = len(pages[group[-1]])
            gates = {d: np.zeros((steps, len(group), 4 * HIDDEN), np.float32) for d in "fb"}
            own, mask = np.zeros((steps, len(group)), np.float32), np.zeros((steps, len(group)), bool)
            for j, i in enumerate(group):
                n, more = len(ids[i]), dense(pages[i])
                mask[:n, j] = True
                own[:n, j] = of_path["own"][ids[i]] + more @ self.p["own"][PATH:]
                for d in "fb":
                    gates[d][:n, j] = of_path[f"x{d}"][ids[i]] + more @ self.p[f"x{d}"][PATH:] + self.p[f"c{d}"]
            z = own + self.p["bias"]
            for k, d in enumerate("fb"):
                z = z + self._run(gates[d], mask, d, False)[0] @ self.p["out"][k * HIDDEN:(k + 1) * HIDDEN]
            for j, i in enumerate(group):
                out[i] = sigmoid(z[:len(ids[i]), j])
        return out


def taught(page: list[Block]) -> list[int] | None:
    """Labels that the markup itself gives, or None if it names no main text."""
    bad = {*BOILERPLATE_TAGS, *(f".{n}" for n in BOILERPLATE_NAMES), *(f"#{n}" for n in BOILERPLATE_NAMES)}
    if not any(b.tokens & set(MAIN_TAGS) for b in page):
        return None
    return [int(bool(b.tokens & set(MAIN_TAGS)) and not b.tokens & bad) for b in page]


def rearranged(r: random.Random, good: list[str], other: list[str]) -> str:
    """A page of another plan from given texts; data-y holds the label of everything below."""
    import html as h

    def text(pool, most=3):
        return h.escape(" ".join(r.choice(pool) for _ in range(r.randint(1, most))))

    def name():
        n = r.choice(BOILERPLATE_NAMES)
        return f' class="{n}"' if r.random() < 0.6 else f' id="{n}"'

    def inner(pool):
        kind = r.randrange(5)
        if kind == 0:
            return "<ul>" + "".join(f'<li><a href="/x">{text(pool, 1)}</a></li>' for _ in range(r.randint(2, 6))) + "</ul>"
        if kind == 1:
            return f"<h3>{text(pool, 1)}</h3><p>{text(pool)}</p>"
        if kind == 2:
            return f"<p>{text(pool)}</p><button>{text(other, 1)}</button>"
        return f"<p>{text(pool)}</p>" * r.randint(1, 2) if kind == 3 else text(pool)

    def boilerplate():
        pool = other if r.random() < 0.5 else good
        kind = r.randrange(6)
        if kind == 0:
            return f'<form data-y="0"{name()}><label>{text(pool, 1)}</label><select><option>{text(pool, 1)}</select></form>'
        if kind == 1:
            tag = r.choice(("nav", "header", "footer", "aside", "dialog", "menu", "noscript"))
            return f'<{tag} data-y="0"{name() if r.random() < 0.4 else ""}>{inner(pool)}</{tag}>'
        if kind == 2:
            return (f'<section data-y="0" {r.choice(("id", "class"))}="comments">'
                    + "".join(f'<div class="comment"><p>{text(pool)}</p></div>' for _ in range(r.randint(1, 4))) + "</section>")
        return f'<{(t := r.choice(("div", "section", "ul", "p")))} data-y="0"{name()}>{inner(pool)}</{t}>'

    def main():
        kind = r.randrange(8)
        if kind == 0:
            return f"<h2>{text(good, 1)}</h2>"
        if kind == 1:
            return "<ul>" + "".join(f"<li>{text(good, 1)}" for _ in range(r.randint(2, 4))) + "</ul>"
        if kind == 2:
            return f"<blockquote><p>{text(good)}</p></blockquote>"
        if kind == 3:
            return f"<p><b>{text(good, 1)}<br>{text(good)}"
        if kind == 4:
            return f"<table><tr><td>{text(good, 1)}<td>{text(good, 1)}</table>"
        return f"<p>{text(good)}</p>"

    body = [main() if r.random() < 0.85 else boilerplate() for _ in range(r.randint(2, 8))]
    tag = r.choice(("article", "main", "div", "section"))
    named = "" if tag in MAIN_TAGS and r.random() < 0.5 else f' {r.choice(("class", "id"))}="{r.choice(MAIN_NAMES)}"'
    around = [boilerplate() for _ in range(r.randint(1, 5))]
    cut = r.randint(0, len(around))
    return (f'<html><head data-y="0"><title>{text(other, 1)}</title></head><body data-y="0">{"".join(around[:cut])}'
            f'<{tag} data-y="1"{named}><h1>{text(good, 1)}</h1>{"".join(body)}</{tag}>{"".join(around[cut:])}</body></html>')


def fit(pages: list[str], plans: int = 400, seed: int = 5) -> Labeller:
    """Train on the pages that teach and on ``plans`` rearrangements of their texts."""
    r = random.Random(seed)
    examples, good, other = [], [], []
    for page in map(blocks, pages):
        labels = taught(page)
        if page and labels:
            examples.append((page, labels))
            for b, y in zip(page, labels):
                (good if y else other).append(b.text)
    good, other = good or ["Some words of a text.", "More words, and an end."], other or ["menu", "share this", "all rights"]
    for _ in range(plans):
        page = blocks(rearranged(r, good, other))
        examples.append((page, [b.mark or 0 for b in page]))
    ready = [(np.concatenate([np.stack([path_vector(b.tokens) for b in page]), dense(page)], 1), np.array(y, float))
             for page, y in examples if page]
    model = Labeller()
    model.train(ready)
    return model


def main_text(page: list[Block], probability: np.ndarray) -> str:
    return " ".join(b.text for b, p in zip(page, probability) if p >= 0.5)


def extract_udf(weights, held_blocks: int = 1 << 15):
    """``weights``: broadcast of the fitted parameters; blocks are held for one group of pages at a time."""
    @F.pandas_udf("text: string, n_chars: long, n_blocks: long, n_kept: long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = Labeller()
        model.p = weights.value
        for batch in batches:
            out, pages = [], []
            for i, html in enumerate(batch):
                pages.append(blocks(html))
                if i + 1 == len(batch) or sum(map(len, pages)) >= held_blocks:
                    for page, q in zip(pages, model.predict(pages)):
                        text = main_text(page, q)
                        out.append((text, len(text), len(page), int((q >= 0.5).sum())))
                    pages = []
            yield pd.DataFrame(out, columns=["text", "n_chars", "n_blocks", "n_kept"])
    return run


def train(pages: DataFrame, *, sample: int = 150, id_col: str = "page_id", html_col: str = "html") -> Labeller:
    """Fit on at most ``sample`` whole pages, chosen by a hash of the id; of an id's pages the one with the smallest hash."""
    ids = (pages.select(F.col(id_col).alias("id")).filter("id IS NOT NULL").distinct()
           .orderBy(F.xxhash64("id"), "id").limit(sample))
    rows = (pages.select(F.col(id_col).alias("id"), F.col(html_col).alias("html"))
            .join(F.broadcast(ids), "id")  # at most ``sample`` ids
            .groupBy("id").agg(F.min(F.struct(F.col("html").isNull(), F.xxhash64("html"), "html")).getField("html").alias("html"))
            .orderBy("id").collect())
    return fit([x.html for x in rows])


def extract(pages: DataFrame, model: Labeller, *, html_col: str = "html", keep: list[str] | None = None) -> DataFrame:
    """Add text, n_chars, n_blocks and n_kept to the ``keep`` columns (default: all)."""
    keep = pages.columns if keep is None else keep
    sent = pages.sparkSession.sparkContext.broadcast(model.p)
    rows = nest(pages, keep, _x=extract_udf(sent)(F.col(html_col)))
    return unnest(rows, keep, **{c: F.col(f"_x.{c}") for c in ("text", "n_chars", "n_blocks", "n_kept")})


def op6_html_extraction(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return extract(pages, train(pages), keep=["page_id", "url"]).select("page_id", "url", "text", "n_chars")
