"""Benchmark decontamination by template canonicalisation.

A text becomes a sequence of tokens in which numbers, names and the units
behind numbers are typed placeholders, so a question keeps its template when
its values change. Windows of the benchmark's templates are hash-joined with
those of the documents (first on 64-bit hashes alone, then, for the documents
that met one, on the tokens themselves). Each alignment of a document with an
item must fill the item's slots consistently: one value of the document for
one value of the item, and the reverse. Windows over inconsistent slots do
not count. A window whose own lower-cased words stand in the document counts
without its template, too. A document is contaminated by an item when such
windows cover the given share of the item's windows. Templates need enough literal
tokens; the lower-cased words of all windows are compared as well, so an item
of numbers and names alone is found by its own words.

DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import read_documents, saved, text_of, whole_row

WORDS = 5
COVERAGE = 0.5
#: A window must hold at least this many literal tokens (of WORDS).
LITERALS = 3
#: Distinct benchmark windows (8 bytes each) up to which their hashes are broadcast.
BROADCAST_WINDOWS = 1_000_000
#: Keys of texts (16 bytes each) up to which they are broadcast to pick those texts.
BROADCAST_KEYS = 1_000_000

NAME, NUMBER, UNIT = "\u0001", "\u0002", "\u0003"
#: Units of measure, recognised behind a number.
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg lb lbs ounce ounces pound pounds ton tons ml l "
    "liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month "
    "months year years percent cent cents dollar dollars euro euros degree degrees"
).split()
_BREAK = rf"[^\p{{L}}\p{{N}}{NAME}{NUMBER}{UNIT}]+"


def _split(s: Column) -> Column:
    """Words of a lower-cased string; the first and the last may be empty."""
    return F.split(F.lower(s), _BREAK)


def _inner(tokens: str) -> Column:
    """Such words without the empty ones at the edges; the empty text has none."""
    head, tail = ((F.element_at(tokens, k) == "").cast("int") for k in (1, -1))
    return F.slice(tokens, head + 1, F.greatest(F.size(tokens) - head - tail, F.lit(0)))


def with_templates(df: DataFrame, text: str) -> DataFrame:
    """``df`` with c (canonical) and o (original), two token arrays of one
    length, whatever the layout, in place of its column ``text``. Numbers are
    runs of digits (separators between digits are dropped first), names are
    capitalised words wherever they stand. Where lower-casing splits a name,
    the canonical tokens are the original ones.

    Each step is a projection of its own, so no expression over a whole text
    stands (and is evaluated) twice.
    """
    t, kept = F.col(text), [x for x in df.columns if x != text]
    marks = t.contains(NAME) | t.contains(NUMBER) | t.contains(UNIT)
    clean = df.select(*kept, F.when(marks, F.translate(t, NAME + NUMBER + UNIT, "   ")).otherwise(t).alias(text))
    spaced = F.regexp_replace(F.regexp_replace(text, r"[.,](?<=\p{N}[.,])(?=\p{N})", ""), r"\p{N}+", " $0 ")
    numbered = F.regexp_replace(text, r"\p{N}+(?:(?<=\p{N})[.,]\p{N}+)*", f" {NUMBER} ")
    named = F.regexp_replace(numbered, r"(?=\p{Lu})(?<![\p{L}\p{N}])\p{Lu}\p{Ll}++(?![\p{L}\p{N}])", NAME)
    unit = rf"(?i){NUMBER}[\s\p{{Z}}]+(?:{'|'.join(UNITS)})(?![\p{{L}}\p{{N}}])"
    measured = F.regexp_replace(named, unit, f"{NUMBER} {UNIT}")
    cut = clean.select(*kept, _split(measured).alias("c"), _split(spaced).alias("o"))
    cut = cut.select(*kept, _inner("c").alias("c"), _inner("o").alias("o"))
    return cut.select(*kept, F.when(F.size("c") == F.size("o"), F.col("c")).otherwise(F.col("o")).alias("c"), "o")


def _starts(tokens: Column, words: int) -> Column:
    """Places 0.. of the windows; texts shorter than a window have one window, empty ones none."""
    last = F.greatest(F.size(tokens) - words, F.lit(0))
    return F.when(F.size(tokens) > 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _window_hashes(tokens: str, words: int) -> Column:
    """The hash of each window; equal to that of the window as an array (absent tokens do not count)."""
    at = lambda i: [F.get(tokens, i + k) for k in range(words)]
    return F.transform(_starts(F.col(tokens), words), lambda i: F.xxhash64(*at(i)))


def _literals(window: Column) -> Column:
    return F.size(F.filter(window, lambda t: ~t.isin(NAME, NUMBER, UNIT)))


def benchmark_windows(benchmark: DataFrame, words: int = WORDS, text: str = "text") -> DataFrame:
    """(item_id, ipos, canon, orig, typed, h, literal_h, n_typed, n_all): the
    windows of every item. Those with enough literal tokens are typed: their
    templates count as well; n_typed and n_all count windows."""
    rows = with_templates(benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), text_of(text).alias("t")), "t")
    at = rows.select("*", F.explode(_starts(F.col("o"), words)).alias("ipos"))
    cut = at.select(
        "item_id", "ipos", F.slice("c", F.col("ipos") + 1, words).alias("canon"), F.slice("o", F.col("ipos") + 1, words).alias("orig")
    )
    need = F.least(F.lit(LITERALS), F.size("canon"))
    cut = cut.withColumn("typed", _literals(F.col("canon")) >= need)
    cut = cut.dropDuplicates(["item_id", "ipos"])
    cut = cut.withColumn("h", F.when(F.col("typed"), F.xxhash64("canon"))).withColumn("literal_h", F.xxhash64("orig"))
    item = Window.partitionBy("item_id")
    return cut.withColumn("n_typed", F.count("h").over(item)).withColumn("n_all", F.count("*").over(item))


def _limited(small: DataFrame, most: int) -> DataFrame:
    """``small`` marked for broadcast if it has at most ``most`` rows; joined by shuffle otherwise."""
    return F.broadcast(small) if small.count() <= most else small


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    """(t, a, b): every text and its key."""
    rows = docs.select(text_of(text).alias("t"))
    return rows.select("t", F.xxhash64("t").alias("a"), F.xxhash64(F.lit("bench"), F.col("t")).alias("b"))


def _hits(docs: DataFrame, hashes: DataFrame, words: int, text: str) -> DataFrame:
    """(a, b, pos, h): texts (by key) and places with a window among ``hashes``; the texts do not move."""
    rows = with_templates(_keyed(docs, text), "t")
    # the windows of the templates, then those of the words; exploded as an expression, because for a
    # column Spark infers a filter that, pushed down, evaluates all of the above again
    both = F.concat(_window_hashes("c", words), _window_hashes("o", words))
    each = rows.select("a", "b", F.size(_starts(F.col("o"), words)).alias("n"), F.posexplode(both).alias("place", "h"))
    hit = each.join(_limited(hashes, BROADCAST_WINDOWS), "h").select("a", "b", (F.col("place") % F.col("n")).alias("pos"), "h")
    # equal texts share a key; a place counts once
    hit = hit.distinct()
    return saved(hit, "bench-hits")


def _covered(matched: DataFrame, coverage: float) -> DataFrame:
    """(a, b, item_id, n_windows, n_matched, coverage) from matched windows (a,
    b, item_id, n_typed, n_all, ipos, typed, literal): of the typed windows in
    either form or of all windows literally, whichever is more."""
    item = ["a", "b", "item_id", "n_typed", "n_all"]
    once = matched.groupBy(*item, "ipos", "typed").agg(F.max("literal").alias("literal"))
    per = once.groupBy(*item).agg(F.count_if("typed").alias("typed"), F.count_if("literal").alias("literal"))
    typed = F.when(F.col("n_typed") > 0, F.col("typed") / F.col("n_typed")).otherwise(0.0)
    literal = F.col("literal") / F.col("n_all")
    pick = lambda x, y: F.when(typed >= literal, x).otherwise(y)
    out = per.select(
        "a",
        "b",
        "item_id",
        pick(F.col("n_typed"), F.col("n_all")).alias("n_windows"),
        pick(F.col("typed"), F.col("literal")).alias("n_matched"),
        pick(typed, literal).alias("coverage"),
    )
    return out.filter(F.col("coverage") >= coverage)


def contaminated(
    docs: DataFrame, benchmark: DataFrame, words: int = WORDS, coverage: float = COVERAGE, text: str = "text"
) -> DataFrame:
    """(a, b, item_id, n_windows, n_matched, coverage): texts (by key) and the items that contaminate them."""
    items = saved(benchmark_windows(benchmark, words), "bench-windows")
    counts = ["item_id", "n_typed", "n_all", "ipos", "typed"]
    keys = items.select(*counts, "literal_h", F.explode(F.array_distinct(F.array("h", "literal_h"))).alias("h"))
    keys = keys.filter("h IS NOT NULL").withColumn("literal", F.col("h") == F.col("literal_h")).drop("literal_h")
    hits = _hits(docs, saved(keys.select("h").distinct(), "bench-hashes"), words, text)
    # texts whose hashes alone could reach the coverage for some item
    near = _covered(hits.join(keys, "h").select("a", "b", *counts, "literal"), coverage)
    near = saved(near.select("a", "b").distinct(), "bench-near")
    places = hits.join(near, ["a", "b"]).groupBy("a", "b").agg(F.collect_set("pos").alias("places"))
    # equal texts give equal rows: one of them is enough
    own = _keyed(docs, text).join(_limited(near, BROADCAST_KEYS), ["a", "b"], "left_semi").dropDuplicates(["a", "b"])
    own = with_templates(own.join(places, ["a", "b"]), "t")
    at = own.select(
        "a",
        "b",
        F.explode(
            F.transform(
                "places",
                lambda p: F.struct(p.alias("pos"), F.slice("c", p + 1, words).alias("dc"), F.slice("o", p + 1, words).alias("do")),
            )
        ).alias("w"),
    ).select("a", "b", "w.*", F.xxhash64("w.dc").alias("h"), F.xxhash64("w.do").alias("literal_h"))
    at = saved(at, "bench-places")
    same = at.select("a", "b", "do", "literal_h").join(items.drop("h"), "literal_h").filter("do = orig")
    pairs = at.drop("literal_h").join(items.drop("literal_h"), "h").filter("dc = canon")
    pairs = saved(pairs.select("a", "b", *counts, (F.col("pos") - F.col("ipos")).alias("shift"), "canon", "orig", "do"), "bench-pairs")
    align = ["a", "b", "item_id", "shift"]
    slots = pairs.select(
        *align,
        "ipos",
        F.explode(
            F.filter(
                F.arrays_zip("canon", "orig", "do"), lambda s: s["canon"].isin(NAME, NUMBER, UNIT)
            )
        ).alias("s"),
    ).select(*align, "ipos", "s.*")
    filled = slots.select(*align, "canon", "orig", "do").distinct()
    bad = (
        filled.groupBy(*align, "canon", "orig").agg(F.count("*").alias("n")).filter("n > 1")
        .select(*align, "canon", F.col("orig").alias("item_value"), F.lit(None).cast("string").alias("doc_value"))
        .unionByName(
            filled.groupBy(*align, "canon", "do").agg(F.count("*").alias("n")).filter("n > 1")
            .select(*align, "canon", F.lit(None).cast("string").alias("item_value"), F.col("do").alias("doc_value"))
        )
    )
    bad_windows = slots.join(
        bad.withColumnRenamed("canon", "kind"),
        align,
    ).filter("canon = kind AND (orig = item_value OR do = doc_value)").select(*align, "ipos").distinct()
    good = pairs.select(*align, *counts[1:]).join(bad_windows, [*align, "ipos"], "left_anti")
    found = good.select("a", "b", *counts, F.lit(False).alias("literal"))
    found = found.unionByName(same.select("a", "b", *counts, F.lit(True).alias("literal")))
    return saved(_covered(found, coverage), "bench-contaminated")


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, words: int = WORDS, coverage: float = COVERAGE, text: str = "text"
) -> DataFrame:
    """doc_id, item_id, n_windows, n_matched, coverage: one row for each
    document row and benchmark item that contaminates it.

    Null and empty texts (of either side) match nothing; items shorter than a
    window are one window as long as they are; a repeated item_id pools its
    rows, the first of equal places counting; repeated documents give repeated
    rows; a null doc_id stays null. Empty tables give an empty result.
    """
    found = contaminated(docs, benchmark, words, coverage, text)
    keyed = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64(text_of(text)).alias("a"),
        F.xxhash64(F.lit("bench"), text_of(text)).alias("b"),
    )
    return keyed.join(found, ["a", "b"]).select("doc_id", "item_id", "n_windows", "n_matched", "coverage")


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, words: int = WORDS, coverage: float = COVERAGE, text: str = "text"
) -> DataFrame:
    """``docs`` without the documents that an item contaminates; all columns kept."""
    found = saved(contaminated(docs, benchmark, words, coverage, text).select("a", "b").distinct(), "bench-drop")
    t = text_of(text)
    keyed = docs.select(whole_row(docs), F.xxhash64(t).alias("a"), F.xxhash64(F.lit("bench"), t).alias("b"))
    return keyed.join(_limited(found, BROADCAST_KEYS), ["a", "b"], "left_anti").select("row.*")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contamination(read_documents(spark, sf_dir), read_documents(spark, sf_dir, "benchmark"))


QUERIES = {"op5_decontamination": op5_decontamination}
