"""Line de-duplication with a suffix array over line sequences.

Every line is known by its 128-bit digest and every line of the corpus by its
place in (doc_id, row, line) order. Prefix doubling ranks the suffixes of the
sequences of lines that hold a word by their first 1, 2, 4, ... such lines: a
round joins each suffix's rank with the rank of the suffix that many lines on,
and with a hash of the blank lines (lines without a word) between the two, and
ranks the pairs. Suffixes alone in their rank drop out, so rounds shrink
quickly. Suffixes of equal rank are an interval of the suffix array whose
longest common prefix has at least that many lines; in each interval the
earliest suffix is the original and every other one starts a later copy.

A run is worth deleting when it has ``min_words`` words. As blank lines are no
place of their own, each ranked line has a word, and a repeated run with that
many words is covered by its windows of at most ``min_words`` ranked lines with
that many words, however many blank lines lie in it. So depths up to
``min_words`` decide everything and deeper ranks would not change a row.
Depths between powers of two are the overlap of two ranked windows. Blank lines
before and behind a window belong to the copy as far as they, too, stand
beside an earlier copy.

DataFrame operations only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import read_documents, saved, text_of, whole_row
from cartwheel.llm.order import running_start

MIN_WORDS = 5
_WORD = r"[^\x20\x09-\x0D]+"


def _row_key(doc_id: Column, text: Column) -> list[Column]:
    """Two 64-bit hashes of (doc_id, text); rows that agree are repeated rows."""
    return [
        F.xxhash64(doc_id, text).alias("_k1"),
        F.xxhash64(F.lit("line"), text, doc_id).alias("_k2"),
    ]


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def line_table(docs: DataFrame, text: str = "text") -> DataFrame:
    """(_k1, _k2, _copy, d, g, u, w0, w1, id, x, y), one row per line: d is the
    place of the row's first line among all lines, g the line's own place, w0
    and w1 the words of the row before and after the line, id the line's
    digest. u numbers the row's lines that hold a word from 1; a blank line has
    the number of the one before it. x and y are two hashes of the blank lines
    since the last line with a word, up to this line (0 if there are none)."""
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        *_row_key(F.col("doc_id").cast("bigint"), text_of(text)),
        F.transform(
            _lines(text_of(text)),
            lambda x: F.struct(F.unhex(F.md5(x)).alias("id"), F.regexp_count(x, F.lit(_WORD)).alias("w")),
        ).alias("lines"),
    )
    # repeated rows hold the same lines: one copy moves, with a count
    same = saved(
        rows.groupBy("doc_id", "_k1", "_k2").agg(F.first("lines").alias("lines"), F.count("*").alias("copies")), "line-rows"
    )
    each = same.select(
        "doc_id", "_k1", "_k2", F.size("lines").alias("n"), F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")
    )
    placed = running_start(
        each, [F.col("doc_id").asc_nulls_last(), "_k1", "_k2", "_copy"], "n", "d", "line-places"
    )
    # the key columns of `placed` equal those of `same`; a null doc_id is inside the hashes
    full = placed.drop("doc_id", "n").join(same.select("_k1", "_k2", "lines"), ["_k1", "_k2"])
    out = full.select("_k1", "_k2", "_copy", "d", F.posexplode("lines").alias("p", "line"))
    # clustered by the join above already, and sorted once for all windows
    so_far = Window.partitionBy("_k1", "_k2", "_copy").orderBy("p")
    earlier = so_far.rowsBetween(Window.unboundedPreceding, -1)
    worded = F.col("line.w") > 0
    out = out.select(
        "*",
        F.sum("line.w").over(so_far).alias("w1"),
        F.count(F.when(worded, 1)).over(so_far).cast("int").alias("u"),
        (F.col("p") - F.coalesce(F.max(F.when(worded, F.col("p"))).over(so_far), F.lit(-1))).alias("back"),
    )
    blank = _blank_hashes(F.col("line.id"), F.col("back"))
    out = out.select(
        "*", *[F.bit_xor(F.when(~worded, h).otherwise(F.lit(0))).over(so_far).alias(f"{c}_all") for c, h in blank.items()]
    )
    since = {
        c: F.col(f"{c}_all").bitwiseXOR(F.coalesce(F.last(F.when(worded, F.col(f"{c}_all")), True).over(earlier), F.lit(0)))
        for c in blank
    }
    return out.select(
        "_k1",
        "_k2",
        "_copy",
        "d",
        (F.col("d") + F.col("p")).alias("g"),
        "u",
        (F.col("w1") - F.col("line.w")).alias("w0"),
        "w1",
        F.col("line.id").alias("id"),
        *[h.alias(c) for c, h in since.items()],
    )


def _blank_hashes(line: Column, place: Column) -> dict[str, Column]:
    """Two hashes of a blank line at a place of its gap; a gap's are the exclusive or of its lines'."""
    return {"x": F.xxhash64(line, place), "y": F.xxhash64(F.lit("blank"), place, line)}


def _intervals(s: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The suffix-array intervals with two or more suffixes: keys, n, first."""
    return saved(s.groupBy(*keys).agg(F.count("*").alias("n"), F.min("g").alias("first")).filter("n > 1"), name)


def _blank_sides(runs: DataFrame, blanks: DataFrame) -> list[DataFrame]:
    """(d, g, span): the blank lines behind and before a repeated window that
    stand there at an earlier place of the window, too."""
    back = F.row_number().over(Window.partitionBy("d", "u").orderBy(F.desc("g")))
    turned = _blank_hashes(F.col("id"), F.col("back"))
    down = Window.partitionBy("d", "u").orderBy("back")
    before = blanks.withColumn("back", back).select("d", "u", "g", *[F.bit_xor(h).over(down).alias(c) for c, h in turned.items()])
    out = []
    for name, beside, u in (("behind", blanks, F.col("u") + F.col("m") - 1), ("before", before, F.col("u") - 1)):
        # the shortest window at the gap decides: longer ones hold it
        at = runs.select("d", u.alias("u"), F.struct("m", "k1", "k2", F.col("g").alias("from")).alias("r"))
        at = at.groupBy("d", "u").agg(F.min("r").alias("r")).select("d", "u", "r.*")
        lines = saved(beside.select("d", "u", "g", "x", "y").join(at, ["d", "u"]), f"blank-{name}")
        keys = ["m", "k1", "k2", "x", "y"]
        sets = lines.groupBy(*keys).agg(F.count("*").alias("n"), F.min("from").alias("first")).filter("n > 1")
        late = lines.join(sets, keys).filter(F.col("from") > F.col("first"))
        out.append(late.select("d", "g", F.lit(0).alias("span")))
    return out


def later_copies(lines: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(d, g, span): the lines from place g to g + span of a run, with at least
    ``min_words`` words, that also starts at an earlier place."""
    found = []

    def keep(s: DataFrame, m: int, k2: str | None = None) -> None:
        many = s.filter(F.col("w1") - F.col("w0") >= min_words)
        key = F.col(k2) if k2 else F.lit(0).cast("bigint")
        found.append(many.select("d", "u", "g", "span", F.lit(m).alias("m"), F.col("rank").alias("k1"), key.alias("k2"), "first"))

    # depth 1: the digest orders the lines; rank = place of the interval in the suffix array
    worded = lines.filter("w1 > w0")
    line_sets = _intervals(worded, ["id"], "lines-1")
    ranked = running_start(line_sets, ["id"], "n", "rank", "lines-1-order")
    span = F.lit(0).alias("span")
    s = saved(worded.join(ranked, "id").select("d", "u", "g", span, "w0", "w1", "x", "y", "rank", "first"), "suffixes-1")
    keep(s, 1)
    depth = 1
    while depth < min_words:
        for m in range(depth + 1, min(2 * depth, min_words) + 1):
            # window m = window `depth` here and window `depth` that ends with it
            ahead = s.select(
                "d",
                (F.col("u") - (m - depth)).alias("u"),
                (F.col("g") + F.col("span")).alias("last"),
                "w1",
                F.col("rank").alias("rank2"),
                # where the windows only touch, the blank lines between them
                *([F.col("x").alias("x2"), F.col("y").alias("y2")] if m == 2 * depth else []),
            )
            pairs = s.select("d", "u", "g", "w0", "x", "y", "rank").join(ahead, ["d", "u"])
            pairs = pairs.withColumn("span", (F.col("last") - F.col("g")).cast("int")).drop("last")
            if m < 2 * depth:
                sets = _intervals(pairs, ["rank", "rank2"], f"lines-{m}")
                keep(pairs.join(sets, ["rank", "rank2"]), m, "rank2")
                continue
            keys = ["rank", "rank2", "x2", "y2"]
            pairs = saved(pairs, f"pairs-{m}")
            sets = _intervals(pairs, keys, f"lines-{m}")
            order = running_start(sets, keys, "n", "next_rank", f"lines-{m}-order")
            new = pairs.join(order, keys).select(
                "d", "u", "g", "span", "w0", "w1", "x", "y", F.col("next_rank").alias("rank"), "first"
            )
        if 2 * depth > min_words:
            break
        s = saved(new, f"suffixes-{2 * depth}")
        keep(s, 2 * depth)
        depth *= 2
    runs = reduce(DataFrame.unionByName, found)
    blanks = lines.filter("w1 = w0")
    sides = []
    if not blanks.isEmpty():
        runs = saved(runs, "line-runs")
        sides = _blank_sides(runs, blanks)
    return reduce(DataFrame.unionByName, sides, runs.filter("g > first").select("d", "g", "span"))


def removed_lines(docs: DataFrame, min_words: int = MIN_WORDS, text: str = "text") -> DataFrame:
    """(_k1, _k2, _copy, _gone): for rows that lose lines, the places of those lines in order."""
    lines = saved(line_table(docs, text), "lines")
    late = later_copies(lines, min_words)
    gone = late.select("d", F.explode(F.sequence(F.col("g") - F.col("d"), F.col("g") - F.col("d") + F.col("span"))).alias("p"))
    per_row = gone.distinct().groupBy("d").agg(F.sort_array(F.collect_list(F.col("p").cast("int"))).alias("_gone"))
    rows = lines.filter("d = g").select("_k1", "_k2", "_copy", "d")
    return saved(per_row.join(rows, "d").select("_k1", "_k2", "_copy", "_gone"), "lines-gone")


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with the text cleaned, and n_lines, n_removed
    and n_runs (maximal removed runs) appended.

    A line goes when it lies in a run of consecutive lines, of any length, with
    together at least ``min_words`` words that also starts at an earlier place,
    places being ordered by doc_id (null last), then by the
    row's hash, then by line; a blank line counts no word. Of repeated rows one
    keeps its lines. A text that is null stays null if it loses nothing, and
    has one (blank) line. Columns named n_lines, n_removed or n_runs are
    replaced; an empty table gives an empty result.
    """
    extra = ["n_lines", "n_removed", "n_runs"]
    gone = removed_lines(docs, min_words, text)
    kept = docs.drop(*extra)
    body = text_of(F.col("row").getField(text))
    id_of = F.col("row").getField("doc_id").cast("bigint")
    keyed = kept.select(whole_row(kept)).select("row", *_row_key(id_of, body))
    # repeated rows are alike, so any numbering of them will do
    copy = F.row_number().over(Window.partitionBy("_k1", "_k2").orderBy("_k1")).cast("bigint")
    joined = keyed.withColumn("_copy", copy).join(gone, ["_k1", "_k2", "_copy"], "left")
    lines = _lines(body)
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_gone"))
    cleaned = F.when(F.col("_gone").isNull(), F.col("row").getField(text)).otherwise(
        F.array_join(F.transform(left, lambda p: F.get(lines, p)), "\n")
    )
    starts = F.filter("_gone", lambda p, i: (i == 0) | (F.get("_gone", i - 1) != p - 1))
    return joined.select(
        *[(cleaned if c == text else F.col("row").getField(c)).alias(c) for c in kept.columns],
        F.size(lines).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("bigint").alias("n_removed"),
        F.when(F.col("_gone").isNull(), 0).otherwise(F.size(starts)).cast("bigint").alias("n_runs"),
    )


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir).select("doc_id", "text")
    out = dedup_lines(docs)
    return out.select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2(text_of("text"), 256).alias("kept_sha256"))


QUERIES = {"op6_line_dedup": op6_line_dedup}

_WINDOWS = "\n  UNION ALL ".join(
    f"SELECT doc_id, pos, {m} AS m, "
    + " || ".join(["h", *[f"h{i}" for i in range(1, m)]])
    + " AS k, "
    + " + ".join(["w", *[f"w{i}" for i in range(1, m)]])
    + " AS words FROM x"
    + (f" WHERE h{m - 1} IS NOT NULL" if m > 1 else "")
    for m in range(1, MIN_WORDS + 1)
)
_LEADS = ", ".join(
    f"lead(h, {i}) OVER o AS h{i}, lead(w, {i}) OVER o AS w{i}" for i in range(1, MIN_WORDS)
)
#: The same answer where every line has a word (as in the driver's tables), from all
#: windows of 1 to MIN_WORDS lines by grouping; no suffix order.
ORACLE = {
    "op6_line_dedup": rf"""
WITH a AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS pos FROM a),
y AS (SELECT doc_id, pos, line, md5(line) AS h, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS w FROM l),
x AS (SELECT *, {_LEADS} FROM y WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
v AS ({_WINDOWS}),
f AS (SELECT *, row_number() OVER (PARTITION BY m, k ORDER BY doc_id, pos) AS rn FROM v WHERE words >= {MIN_WORDS}),
gone AS (SELECT DISTINCT doc_id, pos + unnest(range(m)) AS pos FROM f WHERE rn > 1),
z AS (SELECT y.*, g.pos IS NOT NULL AS cut,
        lag(g.pos IS NOT NULL, 1, false) OVER (PARTITION BY y.doc_id ORDER BY y.pos) AS cut_before
      FROM y LEFT JOIN gone g ON g.doc_id = y.doc_id AND g.pos = y.pos)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE cut) AS n_removed,
  count(*) FILTER (WHERE cut AND NOT cut_before) AS n_runs,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT cut), '')) AS kept_sha256
FROM z GROUP BY doc_id
"""
}
