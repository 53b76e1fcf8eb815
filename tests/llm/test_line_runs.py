"""Operator 6: repeated runs of any length, with lines that hold no word."""

from __future__ import annotations

import random
import re

from cartwheel.llm import line_dedup


def _plain(rows, least=5):
    """Every pair of places and their longest common run, without a bound on its lines."""
    every = [(k, p, x) for k, (_, t) in enumerate(rows) for p, x in enumerate(t.split("\n"))]
    words = [len(re.findall(r"[^\x20\x09-\x0D]+", x)) for _, _, x in every]
    gone = set()
    for b in range(len(every)):
        for a in range(b):
            n = 0
            while b + n < len(every) and every[a + n][2] == every[b + n][2] and every[a + n][0] == every[a][0] and every[b + n][0] == every[b][0]:
                n += 1
            if sum(words[b : b + n]) >= least:
                gone.update(range(b, b + n))
    out = {}
    for k, (i, t) in enumerate(rows):
        mine = [(at, x) for at, (row, _, x) in enumerate(every) if row == k]
        cut = [at in gone for at, _ in mine]
        runs = sum(c and not before for c, before in zip(cut, [False, *cut]))
        out[i] = (len(mine), sum(cut), runs, "\n".join(x for at, x in mine if at not in gone))
    return out


def _removed(spark, rows):
    out = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string"))
    return {r["doc_id"]: (r["n_lines"], r["n_removed"], r["n_runs"], r["text"]) for r in out.collect()}


def test_runs_with_blank_lines(spark):
    double = "\n\n".join(f"w{i}" for i in range(60))
    wide = "\n\n\n".join(f"v{i} v" for i in range(30))
    rows = [(1, double), (2, double), (3, wide), (4, "\n\n" + wide + "\n\nend")]
    got = _removed(spark, rows)
    assert got[2] == (119, 119, 1, "")
    assert got[4][1] == 88 and got == _plain(rows)


def test_random_runs_with_blank_lines(spark):
    rng = random.Random(3)
    pieces = ["a", "b c", "d", "", "", " ", "e f g h i", "\t"]
    rows = [(i, "\n".join(rng.choice(pieces) for _ in range(rng.randrange(1, 25)))) for i in range(30)]
    gaps = "\n".join(["one two", "", " ", "", "three", "", "four five six"])
    rows += [(40, "\n\n\n" + gaps + "\n \n\n"), (41, "\n" + gaps + "\n \n \n"), (42, gaps.replace("\n \n", "\n\n")), (43, "\n\n" + gaps + "\n ")]
    assert _removed(spark, rows) == _plain(rows)
