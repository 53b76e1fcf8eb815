"""Personal data by bootstrapped contextual extraction.

Base entities (email, ip, card, phone) are found by their form. They seed a
graph of patterns (the words to the left of a value) and instances (values).
Spark scores the graph in rounds: a pattern is as good as the share of its
different values that are believed, smoothed so that a pattern seen with few
values stays weak; a value is believed to the degree that its patterns are.
Patterns that end with a high score and enough support mark the unseen
identifiers in their slot: tokens with a digit that no base entity covers.

Places come from one pass per kind that brackets each match in the text,
splits there and keeps lengths only; running sums over a text's parts give
code-point offsets. Texts do not move. DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import read_documents, saved, text_of

ROUNDS = 3
#: A trusted pattern has at least this score and this many different values.
PATTERN_SCORE = 0.7
PATTERN_VALUES = 4
#: Added to a pattern's number of values when its score is taken.
SMOOTHING = 1.0
#: Characters to the left of a value among which its pattern is looked for.
LEFT = 64

OPEN, CLOSE, OTHER = "\u0001", "\u0002", "\u0003"

_LOCAL = "A-Za-z0-9._%+-"
#: The base forms. Matches begin at the left end of a run or right behind the
#: previous match, and runs are possessive: the same matches in linear time.
FORMS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = [*FORMS, "context"]
_RUN = "A-Za-z0-9_@./+-"
#: Identifier-like tokens: runs that hold a digit.
CANDIDATE = rf"(?<![{_RUN}])(?=[A-Za-z_@./+-]*+[0-9])[{_RUN}]++"
LEAST_CANDIDATE = 6

_KEY = ["k1", "k2"]


def _key(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("pii"), text).alias("k2")]


def matches(docs: DataFrame, text: str = "text") -> DataFrame:
    """(k1, k2, kind, start, end, value, left) of all matches of all forms and
    of the candidates (kind "context"); one copy for equal texts. ``left`` is
    the lower-cased text before the match, up to the previous one."""
    t = F.translate(F.col("t"), OPEN + CLOSE, OTHER + OTHER)

    def parts(regex: str) -> Column:
        split = F.split(F.regexp_replace(t, f"({regex})", f"{OPEN}$1{CLOSE}"), OPEN)
        # part 0 is the text before the first match; the others are a match, CLOSE and the text behind it
        return F.transform(
            split,
            lambda p, i: F.struct(
                F.when(i == 0, F.lit(None)).otherwise(F.substring_index(p, CLOSE, 1)).alias("value"),
                F.length(p).alias("n"),
                F.lower(F.right(F.when(i == 0, p).otherwise(F.substring_index(p, CLOSE, -1)), F.lit(LEFT))).alias("tail"),
            ),
        )

    forms = FORMS | {"context": CANDIDATE}
    needs = {"email": "@", "ip": ".", "phone": "+"}
    made = []
    for kind, regex in forms.items():
        found = F.struct(F.lit(kind).alias("kind"), parts(regex).alias("parts"))
        made.append(F.when(F.contains(F.col("t"), F.lit(needs[kind])), found) if kind in needs else found)
    rows = docs.select(text_of(text).alias("t")).filter(F.col("t").rlike("[0-9@]")).select(*_key(F.col("t")), "t")
    each = rows.select(*_KEY, F.explode(F.array(*made)).alias("f")).filter("f IS NOT NULL AND size(f.parts) > 1")
    flat = each.select(*_KEY, "f.kind", F.posexplode("f.parts").alias("i", "p")).select(*_KEY, "kind", "i", "p.*")
    flat = flat.dropDuplicates([*_KEY, "kind", "i"])
    order = Window.partitionBy(*_KEY, "kind").orderBy("i")
    # a part behind the first one holds one CLOSE that the text has not
    size = F.col("n") - F.when(F.col("i") > 0, 1).otherwise(0)
    before = F.coalesce(F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = flat.withColumn("start", before).withColumn("left", F.lag("tail").over(order)).filter("i > 0")
    return placed.select(
        *_KEY, "kind", "start", (F.col("start") + F.length("value")).alias("end"), "value", "left"
    )


def _luhn(value: Column) -> Column:
    digits = F.reverse(F.regexp_replace(value, "[^0-9]", ""))
    each = F.transform(F.split(digits, ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        F.when(d.cast("int") * 2 > 9, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)
    ))
    return F.aggregate(each, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def valid(kind: Column, value: Column) -> Column:
    """Whether a match of a base form counts."""
    digits = F.length(F.regexp_replace(value, "[^0-9]", ""))
    part = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", value.rlike(rf"^{part}(?:\.{part}){{3}}$"))
        .when(kind == "card", digits.between(12, 19) & F.when(digits.between(12, 19), _luhn(value)))
        .when(kind == "phone", digits.between(9, 15))
        .otherwise(False)
    )


def _pattern(left: Column) -> Column:
    """Up to two words before the value, digits as 0; null if there is no word."""
    words = F.regexp_replace(F.trim(F.regexp_replace(left, r"\s+", " ")), "[0-9]", "0")
    last = F.regexp_extract(words, r"((?:[^ ]+ )?[^ ]+)$", 1)
    return F.when(last.rlike(r"\p{L}"), last)


def _believed(edges: DataFrame, rounds: int) -> DataFrame:
    """Patterns with score and support after ``rounds`` of scoring the graph
    ``edges`` (pattern, value, seed)."""
    belief = edges.groupBy("value").agg(F.max("seed").alias("belief"))
    patterns = edges
    for r in range(rounds):
        belief = saved(belief, f"pii-values-{r}")
        patterns = saved(
            edges.join(belief, "value")
            .groupBy("pattern")
            .agg(F.count("*").alias("n"), F.sum("belief").alias("s"))
            .select("pattern", "n", (F.col("s") / (F.col("n") + SMOOTHING)).alias("score")),
            f"pii-patterns-{r}",
        )
        # noisy or over the patterns that have support; a single-value pattern says nothing
        doubt = F.sum(F.log1p(-F.least(F.when(F.col("n") > 1, F.col("score")).otherwise(0.0), F.lit(0.999))))
        found = edges.join(patterns, "pattern").groupBy("value").agg(F.max("seed").alias("seed"), doubt.alias("d"))
        belief = found.select("value", F.greatest(F.col("seed"), 1 - F.exp("d")).alias("belief"))
    return patterns


def spans(docs: DataFrame, rounds: int = ROUNDS, text: str = "text") -> DataFrame:
    """(k1, k2, kind, start, end): base entities and, as kind "context", what trusted patterns add."""
    found = saved(matches(docs, text), "pii-matches")
    is_base = F.col("kind") != "context"
    good = found.filter(~is_base | valid(F.col("kind"), F.col("value")))
    # candidates that no base entity overlaps, by running bounds in text order
    order = Window.partitionBy(*_KEY).orderBy("start", F.col("kind") == "context")
    ends = F.max(F.when(is_base, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    next_start = F.min(F.when(is_base, F.col("start"))).over(order.rowsBetween(0, Window.unboundedFollowing))
    marked = good.withColumn("_ends", ends).withColumn("_next", next_start)
    free = (F.coalesce("_ends", F.lit(0)) <= F.col("start")) & (
        F.col("_next").isNull() | (F.col("_next") >= F.col("end"))
    )
    long = F.length("value") >= LEAST_CANDIDATE
    kept = saved(
        marked.filter(is_base | (free & long)).select(
            *_KEY, "kind", "start", "end", F.lower("value").alias("value"), _pattern(F.col("left")).alias("pattern")
        ),
        "pii-kept",
    )
    seed = F.max((F.col("kind") != "context").cast("double")).alias("seed")
    edges = saved(kept.filter("pattern IS NOT NULL").groupBy("pattern", "value").agg(seed), "pii-edges")
    trusted = _believed(edges, rounds).filter((F.col("score") >= PATTERN_SCORE) & (F.col("n") >= PATTERN_VALUES))
    new = kept.filter(F.col("kind") == "context").join(saved(trusted.select("pattern"), "pii-trusted"), "pattern", "left_semi")
    columns = [*_KEY, "kind", "start", "end"]
    return kept.filter(F.col("kind") != "context").select(*columns).unionByName(new.select(*columns))


def find_personal_data(docs: DataFrame, rounds: int = ROUNDS, text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone,
    base_sha256, spans, n_context.

    ``spans`` lists kind:start:end (code points, end exclusive) by start, then
    kind in the order email, ip, card, phone, context; base_sha256 is the
    digest of the same list without context. A null text is empty and has no
    span. Equal texts have equal spans; the scores come from all texts. Other
    columns are ignored; an empty table gives an empty result.
    """
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    rows = spans(docs, rounds, text).select(*_KEY, F.struct("start", rank.alias("rank"), "end", "kind").alias("s"))
    listed = rows.groupBy(*_KEY).agg(F.sort_array(F.collect_list("s")).alias("s"))
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("s", lambda s: s["kind"] != "context")
    of = lambda k: F.size(F.filter("s", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{k}")
    counts = [of(k) for k in KINDS]
    listed = listed.select(
        *_KEY, *counts, F.array_join(F.transform(base, one), ",").alias("base"), F.array_join(F.transform("s", one), ",").alias("spans")
    )
    listed = saved(listed, "pii-lists")
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), *_key(text_of(text)))
    out = ids.join(listed, _KEY, "left")
    count = lambda k: F.coalesce(F.col(f"n_{k}"), F.lit(0)).cast("bigint").alias(f"n_{k}")
    return out.select(
        "doc_id",
        *[count(k) for k in FORMS],
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
        count("context"),
    )


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(read_documents(spark, sf_dir))


QUERIES = {"op10_pii": op10_pii}
