"""Language identification with segmentation-marginalised unigram models.

Every language has a probability for each piece of one fixed public
vocabulary. A word's probability is the sum over all ways to cut it into
pieces (a forward pass over its letters), so no single segmentation is
committed to. The piece probabilities are fitted by expectation maximisation
over the word counts of all training texts: word counts per language are one
combining aggregate, each round of expected piece counts is another, and only
the model (vocabulary size times languages) comes to the driver.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from cartwheel.llm.common import read_documents, remainder, saved, text_of, tokenizer_path

UNKNOWN = "und"
ROUNDS = 2
#: Pseudo-counts of the pooled piece distribution in each language's own.
POOLED = 1000.0
#: Probability of a letter that no piece covers; the same for all languages.
UNSEEN = 1e-8
#: Longer words are scored as consecutive words of this many letters.
WORD = 64
#: Scale per letter that keeps products of probabilities in range.
SCALE = 100.0
#: Distinct words a worker remembers before it starts anew.
KEPT_WORDS = 400_000
FLUSH = 300_000
#: Words of texts a worker reads ahead before it scores those texts.
AHEAD = 250_000

_word = re.compile(r"[^\W\d_]{1,%d}" % WORD)
_MARK = "▁"


def words(text: str | None) -> list[str]:
    """Runs of letters (Unicode category L), lower-cased, cut at WORD letters."""
    found = _word.findall((text or "").lower())
    if all(map(str.isalpha, found)):
        return found
    # the pattern also takes number signs such as superscripts and Roman numerals
    return [part for w in found for part in "".join(c if c.isalpha() else " " for c in w).split()]


class Vocabulary:
    """The pieces of a sentencepiece file and their lookup for many substrings at once.

    A substring is known by a 64-bit polynomial hash of its code points; two
    tables addressed by different bits of the hash hold the pieces."""

    MULT = np.uint64(0x9E3779B97F4A7C15)
    BITS = 20

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        normal = (
            sp.id_to_piece(i)
            for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))
        )
        self.pieces = sorted({p for p in normal if p and len(p) <= 16})
        self.longest = max(map(len, self.pieces))
        hashes = np.array([self._hash(p) for p in self.pieces], np.uint64)
        if len(np.unique(hashes)) != len(hashes):
            raise ValueError("two pieces share a hash")
        self.keys = np.zeros((2, 1 << self.BITS), np.uint64)
        self.ids = np.full((2, 1 << self.BITS), -1, np.int32)
        left = np.arange(len(hashes))
        for t in range(2):
            slot = self._slot(hashes[left], t)
            _, firsts = np.unique(slot, return_index=True)
            self.keys[t, slot[firsts]] = hashes[left[firsts]]
            self.ids[t, slot[firsts]] = left[firsts]
            left = np.delete(left, firsts)
        self.rest = {int(hashes[i]): int(i) for i in left}  # met in neither table

    def _hash(self, piece: str) -> int:
        h = 0
        for c in piece:
            h = ((h + ord(c) + 1) * int(self.MULT)) % (1 << 64)
        return h

    def _slot(self, h: np.ndarray, t: int) -> np.ndarray:
        return ((h >> np.uint64(64 - self.BITS * (t + 1))) & np.uint64((1 << self.BITS) - 1)).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece ids of hashes, -1 where there is none."""
        slot = self._slot(h, 0)
        out = np.where(self.keys[0, slot] == h, self.ids[0, slot], -1)
        miss = np.flatnonzero(out < 0)
        slot = self._slot(h[miss], 1)
        out[miss] = np.where(self.keys[1, slot] == h[miss], self.ids[1, slot], -1)
        for key, i in self.rest.items():
            out[h == np.uint64(key)] = i
        return out

    def lattice(self, group: list[str]):
        """For words of one length n (the mark included): yields (start, length,
        rows, piece ids) of every piece found in them, by end place."""
        n = len(group[0]) + 1
        points = np.full((len(group), n), ord(_MARK), np.uint64)
        points[:, 1:] = np.frombuffer("".join(group).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(group), n - 1)
        points += np.uint64(1)
        found = defaultdict(list)
        for i in range(n):
            h = np.zeros(len(group), np.uint64)
            for size in range(1, min(self.longest, n - i) + 1):
                h = (h + points[:, i + size - 1]) * self.MULT
                ids = self.find(h)
                rows = np.flatnonzero(ids >= 0)
                if len(rows):
                    found[i + size].append((i, size, rows, ids[rows]))
        return n, found


_vocabularies: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary(path)
    return _vocabularies[path]


def _forward(n: int, rows: int, found, prob) -> np.ndarray:
    """alpha (rows, n + 1, k): scaled sums over all segmentations of the prefixes.
    ``prob(rows, ids)`` gives (len(rows), k)."""
    k = prob(np.zeros(1, np.int64), np.zeros(1, np.int64)).shape[1]
    alpha = np.zeros((rows, n + 1, k))
    alpha[:, 0] = 1
    for j in range(1, n + 1):
        alpha[:, j] = alpha[:, j - 1] * (UNSEEN * SCALE)
        for i, size, at, ids in found.get(j, ()):
            alpha[at, j] += alpha[at, i] * prob(at, ids) * SCALE**size
    return alpha


def score_words(vocab: Vocabulary, group: list[str], model: np.ndarray) -> np.ndarray:
    """Log probability of each word under each language, (words, languages)."""
    out = np.zeros((len(group), model.shape[1]))
    by_length = defaultdict(list)
    for i, w in enumerate(group):
        by_length[len(w)].append(i)
    for size, where in by_length.items():
        for s in range(0, len(where), 20_000):
            at = where[s : s + 20_000]
            n, found = vocab.lattice([group[i] for i in at])
            alpha = _forward(n, len(at), found, lambda rows, ids: model[ids])
            out[at] = np.log(np.maximum(alpha[:, n], 1e-300)) - n * np.log(SCALE)
    return out


def _expected(vocab: Vocabulary, group: list[str], lang: np.ndarray, n_of: np.ndarray, model: np.ndarray) -> np.ndarray:
    """Expected piece counts (pieces, languages) of words with counts, each under its own language."""
    total = np.zeros(model.shape)
    by_length = defaultdict(list)
    for i, w in enumerate(group):
        by_length[len(w)].append(i)
    for where in by_length.values():
        for s in range(0, len(where), 20_000):
            at = np.array(where[s : s + 20_000])
            own = lang[at]
            n, found = vocab.lattice([group[i] for i in at])
            prob = lambda rows, ids: model[ids, own[rows]][:, None]  # noqa: E731, B023
            alpha = _forward(n, len(at), found, prob)[:, :, 0]
            beta = np.zeros((len(at), n + 1))
            beta[:, n] = 1
            z = np.maximum(alpha[:, n], 1e-300)
            share = n_of[at] / z
            flat, weight = [], []
            for j in range(n, 0, -1):  # beta at j is complete when the pieces that end there are taken
                beta[:, j - 1] += beta[:, j] * (UNSEEN * SCALE)
                for i, size, rows, ids in found.get(j, ()):
                    step = prob(rows, ids)[:, 0] * SCALE**size * beta[rows, j]
                    beta[rows, i] += step
                    flat.append(ids.astype(np.int64) * model.shape[1] + own[rows])
                    weight.append(alpha[rows, i] * step * share[rows])
            if flat:
                total += np.bincount(np.concatenate(flat), np.concatenate(weight), model.size).reshape(model.shape)
    return total


def word_counts(train: DataFrame, langs: list[str]) -> DataFrame:
    """(word, lang, n) over all training texts; lang is the place in ``langs``."""
    place = {x: i for i, x in enumerate(langs)}

    def run(batches):
        held: dict[int, Counter] = defaultdict(Counter)

        def out():
            rows = [(w, lang, n) for lang, c in held.items() for w, n in c.items()]
            held.clear()
            return pd.DataFrame(rows, columns=["word", "lang", "n"])

        for pdf in batches:
            for t, lang in zip(pdf["text"], pdf["lang"]):
                held[place[lang]].update(words(t))
                if len(held[place[lang]]) > FLUSH:
                    yield out()
        yield out()

    rows = train.select(text_of("text").alias("text"), "lang").mapInPandas(run, "word string, lang int, n bigint")
    return rows.groupBy("word", "lang").agg(F.sum("n").alias("n"))


def _gathered(batches, rows: int = 100_000):
    """Batches joined to about ``rows`` rows: the work per call is on whole columns."""
    held, n = [], 0
    for pdf in batches:
        held.append(pdf)
        n += len(pdf)
        if n >= rows:
            yield pd.concat(held)
            held, n = [], 0
    if held:
        yield pd.concat(held)


def fit(train: DataFrame, vocabulary_path: str, rounds: int = ROUNDS) -> tuple[list[str], np.ndarray]:
    """Languages and their piece probabilities (pieces, languages), from all rows
    of ``train`` (text, lang) with a language."""
    train = train.select("text", F.col("lang").cast("string").alias("lang")).filter("lang IS NOT NULL")
    langs = sorted(r["lang"] for r in train.select("lang").distinct().collect())  # a label set, not data
    vocab = vocabulary(vocabulary_path)
    n = len(vocab.pieces)
    if not langs:
        return [], np.zeros((n, 0))
    table = saved(word_counts(train, langs), "lang-words")
    model = np.full((n, len(langs)), 1.0 / n)
    sc = train.sparkSession.sparkContext
    for _ in range(rounds):
        shared = sc.broadcast(model)

        def run(batches):
            now, v = shared.value, vocabulary(vocabulary_path)  # noqa: B023
            total = np.zeros(now.shape)
            for pdf in _gathered(batches):
                total += _expected(v, pdf["word"].tolist(), pdf["lang"].to_numpy(), pdf["n"].to_numpy(float), now)
            piece, lang = np.nonzero(total)
            yield pd.DataFrame({"piece": piece, "lang": lang, "n": total[piece, lang]})

        sums = table.mapInPandas(run, "piece int, lang int, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n"))
        got = sums.toPandas()  # at most pieces x languages rows
        count = np.zeros(model.shape)
        count[got["piece"], got["lang"]] = got["n"]
        pooled = (count.sum(axis=1) + 0.5) / (count.sum() + 0.5 * n)
        model = (count + POOLED * pooled[:, None]) / (count.sum(axis=0) + POOLED)
    return langs, model


def predict(docs: DataFrame, langs: list[str], model: np.ndarray, vocabulary_path: str, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score appended (columns of these names are
    replaced); the prediction sees the text alone."""
    shared = docs.sparkSession.sparkContext.broadcast((langs, model))
    kept = docs.drop("lang_pred", "score")
    names = kept.columns

    def run(batches):
        langs, model = shared.value
        vocab = vocabulary(vocabulary_path)
        place: dict[str, int] = defaultdict()
        place.default_factory = place.__len__
        known = np.zeros((0, len(langs)))

        def scored(at):
            nonlocal known
            new = list(itertools.islice(place, len(known), None))
            if new and langs:
                known = np.concatenate((known, score_words(vocab, new, model)))
            for a in at:
                if len(a) and langs:
                    total = known[a].sum(axis=0)
                    p = np.exp(total - total.max())
                    best = int(p.argmax())  # a tie goes to the first language by name
                    yield langs[best], p[best] / p.sum()
                else:
                    yield UNKNOWN, 0.0
            if len(place) > KEPT_WORDS:
                place.clear()
                known = known[:0].copy()

        for batch in batches:
            said, at, ahead = [], [], 0
            for t in batch.column(names.index(text)):
                at.append(np.fromiter(map(place.__getitem__, words(t.as_py())), np.int64))
                ahead += len(at[-1])
                if ahead >= AHEAD:
                    said += scored(at)
                    at, ahead = [], 0
            said += scored(at)
            pred, score = [x for x, _ in said], [x for _, x in said]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                names=[*names, "lang_pred", "score"],
            )

    made = StructType([*kept.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return kept.mapInArrow(run, made)


def identify(
    docs: DataFrame, held_out: Column, vocabulary_path: str, rounds: int = ROUNDS
) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs`` (doc_id, text, lang).

    The model learns from rows that are not held out and have a language;
    predictions use the text alone. A text that is null or has no letter is
    ``und`` with score 0, and so is every text if there is nothing to learn
    from. The score is the posterior of the predicted language under equal
    priors. Repeated rows get equal results; other columns are ignored.
    """
    base = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text_of("text").alias("text"), "lang", held_out.alias("held_out")
    )
    langs, model = fit(base.filter(~F.col("held_out")), vocabulary_path, rounds)
    out = predict(base.select("doc_id", "held_out", "text"), langs, model, vocabulary_path)
    return out.select("doc_id", "held_out", "lang_pred", "score")


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir).select("doc_id", "text", "lang")
    return identify(docs, remainder("doc_id", 4) == 2, tokenizer_path("piece_bpe_32k.model"))


QUERIES = {"op2_language": op2_language}
