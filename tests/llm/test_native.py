"""Operators 5 and 10 against plain versions; both run without Python on the executors."""

from __future__ import annotations

import hashlib
import re

import pytest

from cartwheel.llm import decontaminate, line_dedup, pii
from cartwheel.llm.common import read_documents

from .conftest import awkward_rows

SF = "/root/testdata/sf0.001"
ROWS = [(r[0], r[1] or "") for r in awkward_rows()]


def _luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _base(t):
    forms = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ]
    out = []
    for rank, (kind, form) in enumerate(forms):
        for m in re.finditer(form, t):
            d = re.sub("[^0-9]", "", m.group())
            if {
                "email": lambda: True,
                "ip": lambda: all(int(x) <= 255 for x in m.group().split(".")),  # noqa: B023
                "card": lambda: 12 <= len(d) <= 19 and _luhn(d),  # noqa: B023
                "phone": lambda: 9 <= len(d) <= 15,  # noqa: B023
            }[kind]():
                out.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(out)]


HARD = [
    "a@b.cx@d.e", "a@b.c_d@e.f", "@a@b.c", "x@y", "x@y.", "..@a.b", "1.2.3.4.5.6.7.8", "256.1.1.1", "01.002.0003.4",
    "4111111111111111", "4111-1111 1111-1111", "4111  1111 1111 1111", "0000000000000", "+1 (704) 555-7114.", "+12", "+1+2 345 678 90",
    "++1 234 567 890", "+1((((((((9", "\u0001a@b.c\u0002 +1 704 555 7114", "\U0001f600" * 3 + " a@b.co", "1" * 5000, "a" * 5000 + "@", "a.b" * 900 + "@c.d",
    "x@" + "a." * 3000 + "b", "1.1." * 2000, "a@b.c" * 300,
]


def test_base_spans(spark, awkward):
    rows = [(i, t) for i, t in enumerate(HARD)]
    hard = spark.createDataFrame(rows, "doc_id bigint, text string")
    for df, want in ((awkward, ROWS), (hard, rows)):
        got = pii.find_personal_data(df).collect()
        assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["base_sha256"]) for r in got) == sorted(
            (i is None, i or 0, hashlib.sha256(",".join(_base(t)).encode()).hexdigest()) for i, t in want
        )
        for r in got:
            kinds = [s.split(":")[0] for s in r["spans"].split(",") if s]
            assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [
                kinds.count(k) for k in ("email", "ip", "card", "phone")
            ]


def test_trusted_contexts_find_unseen_identifiers(spark):
    seeds = [(i, f"Please note my contact is u{i}@mail{i}.org for the record {i}.") for i in range(12)]
    new = [(50, "He said his contact is member-88231-x for now"), (51, "The number was member-88231-x once more"), (52, "plain 1234567 text")]
    out = {r["doc_id"]: r for r in pii.find_personal_data(spark.createDataFrame(seeds + new, "doc_id bigint, text string")).collect()}
    at = new[0][1].index("member")
    assert out[50]["spans"] == f"context:{at}:{at + len('member-88231-x')}" and out[50]["n_context"] == 1
    assert out[52]["spans"] == "" and all(out[i]["n_email"] == 1 for i in range(12))


ITEM = "How many kilometres does Maria walk when the old train to Lisbon needs 12 hours and she leaves after 3 km of hills"


def test_contamination_of_templates(spark):
    bench = spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (4, "two words"), (5, "the river was cold and the stones were grey")], "item_id bigint, text string")
    changed = ITEM.replace("Maria", "Jonas").replace("Lisbon", "Porto").replace("12", "40").replace("3 km", "7 miles")
    docs = [
        (1, f"Some text before. {ITEM}. And after."), (2, f"Intro. {changed}? yes"), (3, "nothing of the kind is in this document at all"), (4, None), (5, ""),
        (6, ITEM.lower()), (6, ITEM.lower()), (7, "well two words indeed"), (None, ITEM),
        (9, " ".join(ITEM.split()[:6])),
    ]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = sorted((r["doc_id"] or 0, r["item_id"]) for r in decontaminate.find_contamination(df, bench).collect())
    assert got == [(0, 1), (1, 1), (2, 1), (6, 1), (6, 1)]
    left = decontaminate.drop_contaminated(df.selectExpr("*", "'x' AS a", "'y' AS b", "'z' AS row"), bench)
    assert left.columns == ["doc_id", "text", "a", "b", "row"]
    assert sorted(r["doc_id"] for r in left.collect()) == [3, 4, 5, 7, 9]


def test_inconsistent_slots_do_not_count(spark):
    item = "add 5 apples to 9 pears then take 5 apples from 9 pears and give 5 apples away"
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    same = item.replace("5", "71").replace("9", "64")
    mixed = "add 1 apples to 2 pears then take 3 apples from 4 pears and give 6 apples away"
    docs = spark.createDataFrame([(1, same), (2, mixed)], "doc_id bigint, text string")
    assert [r["doc_id"] for r in decontaminate.find_contamination(docs, bench).collect()] == [1]


def test_contamination_matches_plain_windows(spark):
    docs, bench = read_documents(spark, "/root/testdata/sf0.01"), read_documents(spark, "/root/testdata/sf0.01", "benchmark")
    words = lambda t: re.findall(r"\w+", t.lower())
    items = {r["item_id"]: words(r["text"]) for r in bench.collect()}
    want = set()
    for r in docs.select("doc_id", "text").collect():
        w = words(r["text"])
        have = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
        for i, b in items.items():
            if sum(tuple(b[k : k + 5]) in have for k in range(len(b) - 4)) >= 0.5 * (len(b) - 4):
                want.add((r["doc_id"], i))
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_contamination(docs, bench).collect()}
    assert got == want and got


def test_empty_tables(spark, awkward, nothing):
    bench = spark.createDataFrame([(1, ITEM)], "item_id bigint, text string")
    assert decontaminate.find_contamination(nothing, bench).collect() == []
    assert decontaminate.find_contamination(awkward, bench.limit(0)).collect() == []
    assert decontaminate.drop_contaminated(awkward, bench.limit(0)).count() == len(ROWS)
    assert pii.find_personal_data(nothing).collect() == []


@pytest.mark.parametrize(
    "build",
    [
        lambda s: decontaminate.find_contamination(read_documents(s, SF), read_documents(s, SF, "benchmark")),
        lambda s: line_dedup.dedup_lines(read_documents(s, SF)),
        lambda s: pii.find_personal_data(read_documents(s, SF)),
    ],
)
def test_plans_hold_no_python(spark, build):
    plan = build(spark)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
