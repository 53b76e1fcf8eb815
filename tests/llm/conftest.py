from __future__ import annotations

import random

import pytest

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "row string, k1 string, a string, fp string, n string, score string, lang_pred string, `_k1` string, `rank` string"
)


def _words(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(["stone", "river", "Lamp", "orbit", "seven", "paper", "cloud,", "green."]) + rng.choice("abcdef") for _ in range(n))


def awkward_rows() -> list[tuple]:
    """Nulls, empty and blank texts, one long text with copies, ties, repeated
    rows, runs of one letter, non-Latin signs, shared passages."""
    rng = random.Random(7)
    long = "\n".join(_words(rng, 40) for _ in range(150))
    passage = _words(rng, 90)
    near = _words(rng, 200)
    texts = [
        (1, ""), (2, None), (3, " \t\n "), (4, "a"), (5, long), (6, long), (6, long), (None, "only words without an id here"),
        (None, "only words without an id here"), (9, "a" * 3000), (10, "é" * 900), (11, "naïve…—\u0001\u0002 x@y.zz 1.2.3.4 ok"),
        (12, passage + " one"), (13, "two " + passage), (14, _words(rng, 30) + "\n" + passage + "\n" + _words(rng, 30)),
        (15, near), (16, near + " tail"), (17, near.replace("stone", "stone", 1)), (18, long + " end"), (19, "12345 678"),
        (20, "card 4111 1111 1111 1111 and +1 (415) 555-0132, 300.1.1.1, 10.0.0.255, b.c+d@e-f.co.uk@g.h"),
        (21, "<|endoftext|> don't I'LL ª²½"), (22, "\U0001f600 mail x.y@z.io \U0001f600"), (23, "same\nsame\nsame words in this line\nsame words in this line"),
    ]
    langs = ["en", "de", None]
    return [(i, t, langs[k % 3], "s", len(t or ""), *["x"] * 9) for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
