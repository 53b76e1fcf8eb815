"""Operator 5: layout, case and names at sentence starts; items without literal windows."""

from __future__ import annotations

from cartwheel.llm import decontaminate


def _found(spark, items, docs):
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    got = decontaminate.find_contamination(spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string"), bench)
    return sorted((r["doc_id"], r["item_id"], r["coverage"]) for r in got.collect())


def test_copies_in_other_layout_and_case(spark):
    item = "The teacher told Maria and Peter to write a letter for Anna before the bus to Lisbon took Paul home"
    sums = "Natalia sold 48 clips in the market. Natalia gave 12 of them to Anna for the school."
    other = sums.replace("Natalia", "Brenda").replace("48", "71").replace("12", "35").replace("Anna", "Rosa")
    docs = [item.replace(" ", "\n"), item.replace(" ", "  "), item.lower(), f'He said: "{item}"', "and then " + other]
    assert _found(spark, [item, sums], docs) == [(0, 0, 1.0), (1, 0, 1.0), (2, 0, 1.0), (3, 0, 1.0), (4, 1, 1.0)]


def test_every_item_finds_its_own_copy(spark):
    items = [
        "What is 12 * 7 + 9 - 4?", "Compute 3 + 4 * 5 - 6", "Solve 3 x + 12 = 27", "5 + 6", "Anna", "\u0130stanbul lies here",
        "Then Maria Lopez met Peter Brown and Anna Schmidt in Lisbon with John Carter", "the river was cold and grey",
    ]
    copies = [(k, k, 1.0) for k in range(len(items))]
    assert _found(spark, items, items) == copies
    longer = [f"some words before it {t} and some behind" for t in items]
    assert _found(spark, items, longer) == [c for c in copies if c[0] not in (3, 4, 5)]
