"""Language identification by cross-parsing entropy.

Training text of each language goes into a suffix automaton. A text is parsed
from left to right into the longest phrases that occur in a language's training
text; a phrase that cannot be extended by the next letter ends there and the
next one begins with that letter. Texts of the automaton's language need few
long phrases, others many short ones. The cost of a language is

    phrases * log2(its training letters) / letters parsed

(the cross entropy in bits a letter up to terms that all languages share), and
the cheapest language wins, ties going to the smaller name.

Parsing is vectorised. The automata of all languages share one packed edge list
(state s reads letter c at ``base[s] + c`` if ``check`` there names s), so memory
goes with the training letters, whatever the alphabet; where a state lacks the
letter, the phrase ends and the root reads it (a letter that a language lacks is a
phrase alone). Texts are cut into blocks that advance side by side, each from the
root, and then every block is parsed anew from the state that its predecessor
really ended in, up to the letter where both parses agree; if one does not agree
to its end, its successor is parsed again. So the counts are those of the uncut
text at any block length.

At most ``per_language`` training texts of each language are used, whole, of at
most ``longest`` bytes (a language that has only longer ones teaches its shortest),
chosen by a hash of the id in one pass over narrow rows. The automata are built
once a worker from those texts, which is all that is broadcast.

Defined results: a null text or one without letters is ``und`` with score 0;
without any training text every text is ``und``; repeated rows get equal results;
labels that are null are never learnt; of the texts of an id in a language the one
with the smallest hash is learnt.
"""

from __future__ import annotations

import heapq
import math
import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, hash_slice, nest, table, unnest


#: A transition is a state and, beside it, whether a phrase ended.
ENDED, STATE = np.int32(1 << 30), np.int32((1 << 30) - 1)


def letters_of(text: str | None) -> str:
    """Lower-case words of letters, single blanks around every word; empty without letters."""
    if not text:
        return ""
    kept = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    return f" {' '.join(kept)} " if kept else ""


def suffix_automaton(seq: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a sequence; state 0 is the root."""
    go, link, length, last = [{}], [-1], [0], 0
    for c in seq:
        cur = len(go)
        go.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in go[p]:
            go[p][c] = cur
            p = link[p]
        if p >= 0:
            q = go[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                twin = len(go)
                go.append(dict(go[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and go[p].get(c) == q:
                    go[p][c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    return go


def packed(rows: list[dict[int, int]], width: int, tries: int = 32) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(base, check, target): the edges of all states in shared arrays.

    Rows with most edges are placed first, at random; where ``tries`` places are taken the arrays grow by a
    quarter. Rows of one edge, which most are, fill the gaps.
    """
    base = np.zeros(len(rows), np.int64)
    used = bytearray(2 * width)
    free, r = width, random.Random(0)
    order = sorted((k for k in range(len(rows)) if rows[k]), key=lambda k: (-len(rows[k]), k))
    for state in order:
        letters = list(rows[state])
        if len(letters) == 1:
            while free < len(used) and used[free]:
                free += 1
            at = free - letters[0]
            if at + width > len(used):
                used.extend(bytes(len(used) // 4 + width))
        else:
            fits = False
            while not fits:
                for _ in range(tries):
                    at = r.randrange(len(used) - width + 1)
                    fits = not any(used[at + c] for c in letters)
                    if fits:
                        break
                else:
                    used.extend(bytes(len(used) // 4 + 1))
        for c in letters:
            used[at + c] = 1
        base[state] = at
    check, target = np.full(len(used) + width, -1, np.int32), np.zeros(len(used) + width, np.int32)
    for state in order:
        at = int(base[state])
        for c, to in rows[state].items():
            check[at + c], target[at + c] = state, to
    return base.astype(np.int32), check, target


class Parser:
    """Automata of several languages over one alphabet and in one packed edge list."""

    def __init__(self, samples: dict[str, str]):
        self.names = sorted(n for n, s in samples.items() if s)
        alphabet = sorted(set("".join(samples[n] for n in self.names)))
        # Codes of letters: 1 for letters that no language has, then the alphabet; the blank is in the alphabet.
        self.width = len(alphabet) + 2
        self.code = np.fromiter((chr(i).isalpha() for i in range(0x110000)), np.int32, 0x110000)
        self.code[[ord(c) for c in alphabet]] = np.arange(2, self.width)
        self.blank = int(self.code[32])
        rows: list[dict[int, int]] = []
        self.bits = []
        # What each language's root makes of a letter; state ``lost`` follows one that the language lacks.
        root = np.zeros((len(self.names), self.width), np.int32)
        for i, name in enumerate(self.names):
            seq = self.code[[ord(c) for c in samples[name]]].tolist()
            go, first = suffix_automaton(seq), len(rows)
            lost = first + len(go)
            root[i] = lost
            root[i, list(go[0])] = [first + to for to in go[0].values()]
            rows += [{c: first + to for c, to in edges.items()} for edges in go]
            rows.append({})
            rows[first] = {}  # read through ``root``
            self.bits.append(math.log2(len(seq) + 1))
        self.root = root.ravel()
        self.base, self.check, self.target = packed(rows, self.width)

    def step(self, row: np.ndarray, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Next state, plus ``ENDED`` where a phrase ended before the letter; ``row``: the language's place in ``root``."""
        at = self.base.take(state) + code
        inside = self.check.take(at) == state
        return np.where(inside, self.target.take(at), self.root.take(row + code) | ENDED)

    def encode(self, text: str | None) -> np.ndarray:
        """Codes of ``letters_of(text)``."""
        if not text:
            return np.zeros(0, np.int32)
        codes = self.code[np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)]
        codes[codes == 0] = self.blank
        gap = codes == self.blank
        if gap.all():
            return np.zeros(0, np.int32)
        codes = codes[~(gap & np.concatenate([[False], gap[:-1]]))]
        ends = [np.full(int(codes[i] != self.blank), self.blank, np.int32) for i in (0, -1)]
        return np.concatenate([ends[0], codes, ends[1]])

    def resume(self, path: list, count: np.ndarray, lane: int, tongue: int, state: int, codes: np.ndarray, k: int) -> bool:
        """Parse one block on from letter ``k``, letter by letter; True if it differs from ``path`` to its end."""
        base, check, target, root = map(memoryview, (self.base, self.check, self.target, self.root))
        row, more, flag, mask = tongue * self.width, 0, int(ENDED), int(STATE)
        for k, code in enumerate(codes[k:].tolist(), k):
            at = base[state] + code
            to = target[at] if check[at] == state else root[row + code] | flag
            step = path[k]
            was = int(step[tongue, lane])
            step[tongue, lane] = to
            more += (to >> 30) - (was >> 30)
            state = to & mask
            if state == was & mask:
                break
        else:
            count[tongue, lane] += more
            return True
        count[tongue, lane] += more
        return False

    def phrases(self, texts: list[np.ndarray], block: int, few: int = 64) -> np.ndarray:
        """Phrase counts of encoded texts, one row per text and one column per language.

        Up to ``few`` blocks that still differ from their first parse are finished one by one.
        """
        out = np.zeros((len(texts), len(self.names)), np.int64)
        codes = np.concatenate([*texts, np.zeros(0, np.int32)])
        start, size, owner, at = [], [], [], 0
        for i, t in enumerate(texts):
            for b in range(0, len(t), block):
                start.append(at + b)
                size.append(min(block, len(t) - b))
                owner.append(i)
            at += len(t)
        if not start:
            return out
        start, size, owner = np.array(start), np.array(size), np.array(owner)
        order = np.argsort(-size, kind="stable")  # lanes: blocks by length
        lane_of = np.argsort(order, kind="stable")
        start, size = start[order], size[order]
        live = np.searchsorted(-size, -np.arange(size[0]), side="left")  # lanes longer than each step
        rows = (np.arange(len(self.names), dtype=np.int32) * self.width)[:, None]
        # Every block from the root; path[k][language, lane] is the state after letter k of the block.
        path = [self.root.take(rows + codes[start])]
        count = np.zeros((len(self.names), len(start)), np.int64)
        for k in range(1, size[0]):
            n = live[k]
            path.append(self.step(rows, path[-1][:, :n] & STATE, codes[start[:n] + k]))
            count[:, :n] += path[-1] >> 30
        # Blocks after a text's first, from where their predecessor ended, up to the letter where both parses agree.
        follows = np.flatnonzero(np.concatenate([[False], owner[1:] == owner[:-1]]))
        block_, tongue = np.repeat(follows, len(self.names)), np.tile(np.arange(len(self.names)), len(follows))
        before, lane = lane_of[block_ - 1], lane_of[block_]
        # A predecessor fills its block, so its last letter is number ``block``.
        state = path[block - 1][tongue, before] & STATE if len(block_) else np.zeros(0, np.int32)
        k, late = 0, set()  # blocks (and languages) whose predecessor's end has changed since

        def changed(lane: int, tongue: int) -> None:
            after = int(order[lane]) + 1
            if after < len(owner) and owner[after] == owner[after - 1]:
                late.add((after, tongue))

        while len(lane) > few:
            to = self.step(rows[tongue, 0], state, codes[start[lane] + k])
            was = path[k][tongue, lane]
            path[k][tongue, lane] = to
            count[tongue, lane] += (to >> 30) - (was >> 30)
            state = to & STATE
            differ = state != was & STATE
            k += 1
            for i in np.flatnonzero(differ & (size[lane] == k)).tolist():
                changed(int(lane[i]), int(tongue[i]))
            more = differ & (size[lane] > k)
            lane, tongue, state = lane[more], tongue[more], state[more]
        for one, of, at in zip(lane.tolist(), tongue.tolist(), state.tolist()):
            if self.resume(path, count, one, of, at, codes[start[one]:start[one] + size[one]], k):
                changed(one, of)
        # In order, so that each of them starts from its predecessor's last word.
        heap, queued = sorted(late), set(late)
        while heap:
            after, of = heapq.heappop(heap)
            one, at = int(lane_of[after]), int(path[block - 1][of, lane_of[after - 1]] & STATE)
            late.clear()
            if self.resume(path, count, one, of, at, codes[start[one]:start[one] + size[one]], 0):
                changed(one, of)
                if late and late.isdisjoint(queued):
                    heapq.heappush(heap, *late)
                    queued |= late
        np.add.at(out, owner[order], count.T)
        out[np.unique(owner)] += 1
        return out

    def predict(self, texts: list[str | None], block: int = 1024, cells: int = 1 << 23) -> list[tuple[str, float]]:
        """``cells``: letters times languages that are held at a time, unless one text alone has more."""
        batch_letters = cells // max(1, len(self.names))
        out: list[tuple[str, float]] = []
        group: list[np.ndarray] = []
        held = 0
        for i, t in enumerate(texts):
            group.append(self.encode(t) if self.names else np.zeros(0, np.int32))
            held += len(group[-1])
            if i + 1 == len(texts) or held >= batch_letters:
                out += self._group(group, block)
                group, held = [], 0
        return out

    def _group(self, texts: list[np.ndarray], block: int) -> list[tuple[str, float]]:
        if not self.names:
            return [("und", 0.0)] * len(texts)
        cost = self.phrases(texts, block) * np.array(self.bits)
        best = cost.argmin(1)  # first of equals: the smaller name
        low = cost[np.arange(len(texts)), best]
        rest = cost.copy()
        rest[np.arange(len(texts)), best] = np.inf
        second = rest.min(1) if len(self.names) > 1 else np.full(len(texts), np.inf)
        return [(self.names[b], 1.0 if math.isinf(s) else float(s / (s + x))) if len(t) else ("und", 0.0)
                for t, b, x, s in zip(texts, best, low, second)]


def learn(docs: DataFrame, *, per_language: int = 100, longest: int = 20_000, id_col: str = "doc_id",
          text_col: str = "text", lang_col: str = "lang", broadcast_rows: int = 100_000) -> dict[str, str]:
    """Training letters of each language, from documents outside the held-out quarter."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    known = (rows.filter(F.col("id").isNotNull() & F.col("lang").isNotNull() & ~hash_slice(F.col("id"), 4, 2))
             .select("id", "lang", F.col("text").isNull().alias("none"), F.xxhash64("text").alias("h"),
                     F.coalesce(F.octet_length("text"), F.lit(0)).alias("size"))
             .groupBy("id", "lang").agg(F.min(F.struct("none", "h", "size")).alias("t")))
    over = F.col("t.size") > longest
    order = Window.partitionBy("lang").orderBy(over, F.when(over, F.col("t.size")), F.xxhash64("id"), "id")
    chosen = cut(known.withColumn("rank", F.row_number().over(order))
                 .filter((F.col("rank") <= per_language) & (~over | (F.col("rank") == 1)))
                 .select("id", "lang", F.col("t.h").alias("h")))
    if chosen.count() <= broadcast_rows:  # at most ``per_language`` narrow rows a language
        chosen = F.broadcast(chosen)
    texts = (rows.withColumn("h", F.xxhash64("text")).join(chosen, ["id", "lang", "h"])
             .groupBy("lang", "id").agg(F.min("text").alias("text")).orderBy("lang", "id").collect())
    out: dict[str, str] = {}
    for r in texts:
        out[r.lang] = out.get(r.lang, "") + letters_of(r.text)
    return out


def predict_udf(samples):
    """``samples``: broadcast of {'samples': ...}; the parser stays built in the worker."""
    @F.pandas_udf("lang_pred: string, score: double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        held = samples.value
        parser = held.setdefault("built", None) or Parser(held["samples"])
        held["built"] = parser
        for texts in batches:
            found = parser.predict(list(texts))
            yield pd.DataFrame({"lang_pred": [n for n, _ in found], "score": [float(s) for _, s in found]})
    return run


def identify(docs: DataFrame, samples: dict[str, str], *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Add held_out, lang_pred and score to every row."""
    sent = docs.sparkSession.sparkContext.broadcast({"samples": samples})
    rows = nest(docs, docs.columns, _id=F.col(id_col), _p=predict_udf(sent)(F.col(text_col)))
    return unnest(rows, docs.columns, held_out=hash_slice(F.col("_id"), 4, 2), lang_pred=F.col("_p.lang_pred"),
                  score=F.col("_p.score"))


def op3_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(docs.select("doc_id", "text"), learn(docs, per_language=16)).select("doc_id", "held_out", "lang_pred", "score")
