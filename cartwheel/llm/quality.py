"""Text quality by a generalised additive model with pairwise interactions.

A text is described by shares, ratios and sizes of its own (``FEATURES``).
Each feature is cut into bins, and the model is a sum: one lookup table for
each feature, one small two-way table for each of the strongest pairs, and an
intercept. The tables are grown by cyclic boosting: rounds go over the
features in turn, each time a shallow tree over the one feature's bins is
fitted to what is left and added to its table at a low rate, so correlated
features share what they explain. Pairs are then ranked by how much of the
rest a tree with one cut on either side explains, and the best are boosted in
turn in the same way. A score is a few additions of table entries per text,
and every table can be read on its own.

The model is fitted on a bounded sample of labelled rows (``FIT_ROWS``); the
description and the score of every text are computed where the text is.
"""

from __future__ import annotations

import math
import operator
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.common import read_documents, remainder, saved, text_of

#: About this many labelled rows, chosen by a hash of their ids, fit the model.
FIT_ROWS = 50_000
#: Bins of a feature in its own table, and in a table of pairs.
BINS, PAIR_BINS = 32, 8
ROUNDS, RATE, LEAVES = 200, 0.1, 3
PAIRS = 8
#: Rows a leaf holds at least, and what is added to its sum of second derivatives.
LEAST, RIDGE = 5, 1.0
#: Rounds without a better loss on the rows set aside (one in SET_ASIDE) end the boosting.
PATIENCE, SET_ASIDE = 20, 5

FEATURES = [
    "log_bytes", "log_words", "word_bytes", "log_lines", "line_words", "space", "lower", "upper_of_letters", "digits", "high_bytes",
    "control", "sentence_marks", "brackets", "signs", "commonest_mark", "entropy", "distinct_words", "commonest_word", "single_words",
    "distinct_pairs", "distinct_lines", "no_letter_words", "signed_words", "capital_words", "upper_words", "long_words",
    "repeated_words",
]

_LETTERS = b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
_MARKS = b".,;:!?"
_BRACKETS = b"()[]{}<>\"'"
_SIGNS = bytes(b for b in range(33, 127) if not bytes([b]).isalnum() and b not in _MARKS and b not in _BRACKETS)
_PRINTED = np.array([b for b in range(33, 127) if not bytes([b]).isalnum()])
_STRIDE = 1 << 20


def _of(hist: np.ndarray, some: bytes) -> int:
    return int(hist[list(some)].sum())


def describe(text: str | None) -> list[float]:
    """The features of one text, in the order of FEATURES (empty: all 0)."""
    data = (text or "").encode("utf-8", "surrogatepass")
    if not data:
        return [0.0] * len(FEATURES)
    raw = np.frombuffer(data, np.uint8)
    hist = sum(np.bincount(raw[i : i + _STRIDE], minlength=256) for i in range(0, len(raw), _STRIDE))
    n = len(data)
    lower, upper = int(hist[97:123].sum()), int(hist[65:91].sum())
    some = hist[hist > 0] / n
    words = data.split()
    w = max(1, len(words))
    seen = Counter(words)
    lines = [line for line in data.split(b"\n") if line.strip()]
    rows = max(1, len(lines))
    no_letter = signed = capital = shouted = long = 0
    for word, times in seen.items():
        last = word[-1]
        if word.isalpha():
            pass
        elif last < 128 and last in _SIGNS:
            signed += times
        if word[0] < 128 and 65 <= word[0] <= 90:
            capital += times
            if len(word) > 1 and word.isupper():
                shouted += times
        elif word.translate(None, _LETTERS) == word and max(word) < 128:
            no_letter += times
        if len(word) > 24:
            long += times
    return [
        math.log1p(n), math.log1p(len(words)), sum(map(len, words)) / w, math.log1p(len(lines)), math.log1p(w / rows),
        (int(hist[9:14].sum()) + int(hist[32])) / n, lower / n, upper / max(1, lower + upper), int(hist[48:58].sum()) / n,
        int(hist[128:].sum()) / n, (int(hist[:9].sum()) + int(hist[14:32].sum()) + int(hist[127])) / n, _of(hist, _MARKS) / n,
        _of(hist, _BRACKETS) / n, _of(hist, _SIGNS) / n, int(hist[_PRINTED].max()) / n, float(-(some * np.log2(some)).sum()),
        len(seen) / w, max(seen.values(), default=0) / w, sum(1 for t in seen.values() if t == 1) / w,
        len(set(zip(words, words[1:]))) / max(1, len(words) - 1), len(set(lines)) / rows, no_letter / w, signed / w, capital / w,
        shouted / w, long / w, sum(map(operator.eq, words, words[1:])) / w,
    ]


def described(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` but text, and ``x``: the features of the text."""
    kept = [c for c in docs.columns if c != "text"]

    def run(batches):
        for pdf in batches:
            out = pdf[kept].copy()
            out["x"] = [describe(t) for t in pdf["text"]]
            yield out

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema)
    return docs.mapInPandas(run, f"{schema}, x array<double>")


@dataclass
class Gam:
    """Intercept, one table per feature, and tables of pairs (i, j) over coarser bins."""

    edges: list[np.ndarray]
    intercept: float = 0.0
    mains: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, k], "right") for k, e in enumerate(self.edges)]) if len(x) else np.zeros(x.shape, int)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        out = np.full(len(x), self.intercept)
        for k, table in enumerate(self.mains):
            out += table[b[:, k]]
        for (i, j), table in zip(self.pairs, self.tables):
            out += table[self.coarse[i][b[:, i]], self.coarse[j][b[:, j]]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(x), -30, 30)))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + RIDGE)


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, leaves: int = LEAVES) -> np.ndarray:
    """The step for each bin: a tree with up to ``leaves`` leaves over bins
    with gradient sums g and h and n rows."""
    cuts = [0, len(g)]
    cg, ch, cn = (np.concatenate(([0.0], np.cumsum(t))) for t in (g, h, n))
    while len(cuts) - 1 < leaves:
        best, where = 1e-9, None
        for a, b in zip(cuts, cuts[1:]):
            m = np.arange(a + 1, b)
            if not len(m):
                continue
            lg, lh, rg, rh = cg[m] - cg[a], ch[m] - ch[a], cg[b] - cg[m], ch[b] - ch[m]
            won = _gain(lg, lh) + _gain(rg, rh) - _gain(cg[b] - cg[a], ch[b] - ch[a])
            won = np.where((cn[m] - cn[a] >= LEAST) & (cn[b] - cn[m] >= LEAST), won, -1)
            k = int(won.argmax())
            if won[k] > best:
                best, where = won[k], int(m[k])
        if where is None:
            break
        cuts = sorted([*cuts, where])
    out = np.zeros(len(g))
    for a, b in zip(cuts, cuts[1:]):
        out[a:b] = -(cg[b] - cg[a]) / (ch[b] - ch[a] + RIDGE)
    return out


def _four(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and steps of the best tree with one cut on either side of a two-way table."""
    r, c = g.shape
    parts = []  # sums of the four leaves, for every pair of cuts
    for table in (g, h, n):
        t = np.pad(table.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
        a = t[1:r, 1:c]
        parts.append((a, t[1:r, c:] - a, t[r:, 1:c] - a, t[r, c] - t[1:r, c:] - t[r:, 1:c] + a))
    if not parts[0][0].size:
        return 0.0, np.zeros(g.shape)
    won = sum(_gain(x, y) for x, y in zip(*parts[:2])) - _gain(g.sum(), h.sum())
    enough = np.minimum.reduce(parts[2]) >= LEAST
    won = np.where(enough, won, -1.0)
    i, j = np.unravel_index(int(won.argmax()), won.shape)
    out = np.zeros(g.shape)
    if won[i, j] <= 0:
        return 0.0, out
    for rows in (slice(0, i + 1), slice(i + 1, r)):
        for cols in (slice(0, j + 1), slice(j + 1, c)):
            out[rows, cols] = -g[rows, cols].sum() / (h[rows, cols].sum() + RIDGE)
    return float(won[i, j]), out


def fit(x: np.ndarray, y: np.ndarray, aside: np.ndarray) -> Gam:
    """The model of labels ``y`` (0 or 1) from features ``x``; rows ``aside`` only
    decide when to stop. With one class alone (or no row) it says that class's share (0.5)."""
    edges = []
    for k in range(x.shape[1]):
        q = np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1]) if len(x) else np.zeros(0)
        edges.append(np.unique(q))
    gam = Gam(edges)
    share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
    gam.intercept = math.log(share / (1 - share))
    gam.mains = [np.zeros(len(e) + 1) for e in edges]
    gam.coarse = [np.arange(len(e) + 1) * PAIR_BINS // (len(e) + 1) for e in edges]
    if not len(y) or y.min() == y.max() or aside.all():
        return gam
    b = gam.bins(x)
    z = np.full(len(y), gam.intercept)
    use = ~aside

    def loss() -> float:
        at = aside if aside.any() else use
        return float(np.logaddexp(0, np.where(y[at] == 1, -z[at], z[at])).mean())

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-z))
        return (p - y)[use], (p * (1 - p))[use]

    def boost(tables: list[np.ndarray], places: list[np.ndarray], grow) -> None:
        """Rounds over the tables; keeps those of the round with the least loss."""
        nonlocal z
        best, since, kept, kept_z = loss(), 0, [t.copy() for t in tables], z.copy()
        rows = [np.bincount(p[use], minlength=t.size).reshape(t.shape) for t, p in zip(tables, places)]
        for _ in range(ROUNDS):
            for table, place, n in zip(tables, places, rows):
                g, h = slopes()
                mine = place[use]
                sums = [np.bincount(mine, v, table.size).reshape(table.shape) for v in (g, h)]
                step = RATE * grow(*sums, n)
                table += step
                z = z + step.ravel()[place]
            now = loss()
            if now < best - 1e-6:
                best, since, kept, kept_z = now, 0, [t.copy() for t in tables], z.copy()
            else:
                since += 1
                if since >= PATIENCE:
                    break
        for table, good in zip(tables, kept):
            table[...] = good
        z = kept_z

    boost(gam.mains, [b[:, k] for k in range(b.shape[1])], _tree)
    rough = [c[b[:, k]] for k, c in enumerate(gam.coarse)]
    sizes = [int(c.max()) + 1 for c in gam.coarse]
    g, h = slopes()
    ranked = []
    for i in range(len(sizes)):
        for j in range(i + 1, len(sizes)):
            place = (rough[i] * sizes[j] + rough[j])[use]
            sums = [np.bincount(place, v, sizes[i] * sizes[j]).reshape(sizes[i], sizes[j]) for v in (g, h, None)]
            ranked.append((-_four(*sums)[0], i, j))
    gam.pairs = [(i, j) for won, i, j in sorted(ranked)[:PAIRS] if won < 0]
    gam.tables = [np.zeros((sizes[i], sizes[j])) for i, j in gam.pairs]
    places = [rough[i] * sizes[j] + rough[j] for i, j in gam.pairs]
    boost(gam.tables, places, lambda g, h, n: _four(g, h, n)[1])
    return gam


def learn(docs: DataFrame, labels: DataFrame, held_out: Column, limit: int = FIT_ROWS) -> Gam:
    """The model from rows of ``docs`` (doc_id, text) that are not held out and
    have a label (doc_id, label 0 or 1). Of more than ``limit`` labelled ids
    those with the smallest hashes are taken, about ``limit`` of them."""
    known = labels.filter("label IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("label").alias("label"))
    known = saved(known.filter(~held_out), "quality-labels")
    n = known.count()
    part = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    picked = known.filter(part < (limit * (1 << 30)) // n) if n > limit else known
    # about `limit` rows of two numbers
    rows = docs.filter(~held_out).join(F.broadcast(picked), "doc_id").select("doc_id", "label", "text")
    # one row an id, however often the id is repeated
    one = described(rows).groupBy("doc_id").agg(F.min(F.struct("x", "label")).alias("r")).select("doc_id", "r.*")
    got = one.toPandas().sort_values("doc_id")  # `limit` rows of FEATURES numbers
    x = np.array(got["x"].tolist(), float).reshape(len(got), len(FEATURES))
    order = np.random.default_rng(11).permutation(len(got))  # rows to set aside are drawn, not by id
    return fit(x, got["label"].to_numpy(float), order % SET_ASIDE == 0)


def score_quality(docs: DataFrame, labels: DataFrame, held_out: Column, limit: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs`` (doc_id, text).

    Labels (doc_id, quality) are learned from rows that are not held out. A
    null label counts as missing; a doc_id with several labels takes the
    largest; a repeated doc_id is learned from once. Null and empty texts have
    all features 0 and the score of such a text; rows with a null id are
    scored like others. Without labels every score is 0.5. Repeated rows get
    equal results; an empty table gives an empty result; columns other than
    doc_id and text are ignored.
    """
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of("text").alias("text"))
    marks = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), (F.col("quality") > 0).cast("int").alias("label"))
    shared = docs.sparkSession.sparkContext.broadcast(learn(base, marks, held_out, limit))  # a few thousand numbers

    def run(batches):
        for pdf in batches:
            x = np.array([describe(t) for t in pdf["text"]], float).reshape(len(pdf), len(FEATURES))
            score = shared.value.score(x)
            yield pd.DataFrame({
                "doc_id": pdf["doc_id"].astype("Int64"), "held_out": pdf["held_out"], "score": score,
                "predicted": (score >= 0.5).astype("int32"),
            })

    rows = base.withColumn("held_out", held_out).select("doc_id", "held_out", "text")
    return rows.mapInPandas(run, "doc_id bigint, held_out boolean, score double, predicted int")


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_documents(spark, sf_dir), read_documents(spark, sf_dir, "labels")
    return score_quality(docs, labels, remainder("doc_id", 3) == 1)


QUERIES = {"op11_quality": op11_quality}
