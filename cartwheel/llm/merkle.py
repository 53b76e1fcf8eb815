"""Merkle manifest of a table of documents.

Every row is a leaf: the SHA-256 of its fields, each with its length. The
leaves of one language, in the order of their ids, are paired and hashed level
by level up to the language's subroot; the subroots are paired likewise up to
the root. A manifest answers two questions per row: the proof (the sibling
digests on the way to the root), and whether the row as it is now still leads
to the root.

The tree is built in pages. A page holds 2**STRIDE neighbouring nodes of one
level and the levels above them up to a single node, so a tree of 2**40 leaves
has five levels of pages, and one group never holds more than 2**STRIDE nodes.
The built levels are stored as node rows with a link to their parent: a row for
every bottom page, and above it rows of up to REACH levels each. Upper nodes
are stored once for every bottom page below them, cut to the siblings on that
page's way: a key therefore never serves more than 2**STRIDE leaves, although
the nodes near the root lie on the way of every leaf.

A recursive query then climbs from all leaves at once: each step joins the
leaf's row with the node row it has reached, appends the siblings found there
to its proof, folds them into its digest and follows the parent link.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.common import read_documents, saved
from cartwheel.llm.order import running_start

#: Levels of the binary tree in one page.
STRIDE = 8
#: Levels above the bottom pages in one node row, so in one step of the climb.
REACH = 16
#: The tree of the subroots; the languages' trees are numbered from 0.
CROWN = -1
#: Rows of the global order that share one row of the table of language starts.
BLOCK_BITS = 16

_LIMITS = ("spark.sql.cteRecursionRowLimit", "spark.sql.cteRecursionLevelLimit")


def _field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(n_chars: Column | None = None) -> Column:
    """The leaf of a row with doc_id, source, lang, n_chars, text (``n_chars`` in place of its own)."""
    count = F.col("n_chars") if n_chars is None else n_chars
    values = [F.col("doc_id"), F.col("source"), F.col("lang"), count, F.col("text")]
    return F.sha2(F.concat(*[_field(v) for v in values]), 256)


def tampered(modulus: int = 7) -> Column:
    """Rows whose n_chars the check raises by one (none without an id)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == 0, F.lit(False))


def _ranked(leaves: DataFrame) -> DataFrame:
    """``leaves`` (lang, doc_id, leaf binary, ..) with tree (number of the language),
    pos (place in it) and n (its size).

    The order is global over (lang, doc_id, leaf), null first. Each stretch of
    2**BLOCK_BITS places has its own row in the table of starts, so a language
    with most of the rows meets it in many small groups.
    """
    marked = leaves.withColumn("tie", F.monotonically_increasing_id()).withColumn("one", F.lit(1).cast("bigint"))
    at = running_start(marked, ["lang", "doc_id", "leaf", "tie"], "one", "at", "merkle-order")
    at = saved(at.drop("tie", "one").withColumn("block", F.shiftright("at", BLOCK_BITS)), "merkle-at")
    parts = at.groupBy("block", "lang").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    parts = saved(parts, "merkle-parts")
    langs = parts.groupBy("lang").agg(F.min("first").alias("first"), F.sum("n").alias("n"), F.lit(1).cast("bigint").alias("one"))
    langs = running_start(saved(langs, "merkle-langs"), ["lang"], "one", "tree", "merkle-trees").drop("one")
    p, t = parts.select("block", F.col("lang").alias("_lang")), langs.withColumnRenamed("lang", "_name")
    starts = p.join(t, F.col("_lang").eqNullSafe(F.col("_name"))).select("block", "_lang", "first", "n", "tree")
    starts = saved(starts.withColumnRenamed("block", "_block"), "merkle-starts")
    same = (F.col("block") == F.col("_block")) & F.col("lang").eqNullSafe(F.col("_lang"))
    return at.join(starts, same).withColumn("pos", F.col("at") - F.col("first")).drop("at", "block", "_block", "_lang", "first")


def _pages(nodes: DataFrame, stride: int) -> DataFrame:
    """Nodes (tree, pos, digest binary, n) of one level, n nodes in their tree, as
    pages: tree, page, pages (of this tree), levels, top.

    levels[0] are the page's nodes, each further level the digests of pairs
    (an odd last node is hashed alone). The only page of a tree ends with one
    node; a page among others always has ``stride`` levels of pairs above its
    nodes, because the tree goes on above it.
    """
    width = 1 << stride
    grouped = nodes.groupBy("tree", "n", F.shiftright("pos", stride).alias("page")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "digest"))).alias("held")
    )
    pages = F.shiftright(F.col("n") + (width - 1), stride)
    out = grouped.select(
        "tree", "page", pages.alias("pages"), F.transform("held", lambda x: x["digest"]).alias("level"),
        F.array().cast("array<array<binary>>").alias("levels"),
    )

    def paired(level: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(level), F.lit(2))
        both = lambda i: F.concat(*[F.coalesce(F.lower(F.hex(F.try_element_at(level, i + k))), F.lit("")) for k in (0, 1)])
        return F.transform(starts, lambda i: F.unhex(F.sha2(both(i), 256)))

    for _ in range(stride):
        more = (F.col("pages") > 1) | (F.size("level") > 1)
        grown = F.concat("levels", F.array("level"))
        out = out.withColumns({
            "levels": F.when(more, grown).otherwise(F.col("levels")),
            "level": F.when(more, paired(F.col("level"))).otherwise(F.col("level")),
        })
    return out.select("tree", "page", "pages", "levels", F.element_at("level", 1).alias("top"))


def _built(leaves: DataFrame, stride: int) -> list[DataFrame]:
    """All pages from the root's down to the bottom, by level of pages: tree,
    stage, page, pages, levels, top, and parent_tree, parent_stage,
    parent_page, slot (place among the parent's nodes)."""
    mask = (1 << stride) - 1
    made: list[DataFrame] = []
    subroots: list[DataFrame] = []

    def climb(nodes: DataFrame, crown: bool) -> None:
        stage = 0
        while True:
            pages = _pages(nodes, stride).withColumn("stage", F.lit(stage))
            last = F.col("pages") == 1
            above = F.col("tree")  # where a language's subroot stands among the subroots
            no_parent = F.lit(None).cast("bigint")
            linked = pages.select(
                "tree", "stage", "page", "pages", "levels", "top",
                F.when(~last, F.col("tree")).otherwise(no_parent if crown else F.lit(CROWN)).cast("bigint").alias("parent_tree"),
                F.when(last, 0).otherwise(stage + 1).alias("parent_stage"),
                F.when(last, no_parent if crown else F.shiftright(above, stride)).otherwise(F.shiftright("page", stride)).alias("parent_page"),
                F.when(last, F.lit(0).cast("bigint") if crown else above.bitwiseAND(mask)).otherwise(F.col("page").bitwiseAND(mask)).cast("int").alias("slot"),
            )
            kept = saved(linked, f"merkle-pages-{'crown' if crown else 'tree'}-{stage}")
            made.append(kept)
            if not crown:
                subroots.append(kept.filter("pages = 1").select("tree", F.col("top").alias("subroot")))
            upper = kept.filter("pages > 1")
            if upper.isEmpty():
                return
            nodes = upper.select("tree", F.col("page").alias("pos"), F.col("top").alias("digest"), F.col("pages").alias("n"))
            stage += 1

    climb(leaves.select("tree", "pos", F.col("leaf").alias("digest"), "n"), False)
    roots = subroots[0]
    for s in subroots[1:]:
        roots = roots.unionByName(s)
    crown = roots.select(F.lit(CROWN).cast("bigint").alias("tree"), F.col("tree").alias("pos"), F.col("subroot").alias("digest"))
    trees = roots.agg(F.count("*")).first()[0]
    climb(crown.withColumn("n", F.lit(trees).cast("bigint")), True)
    return made[::-1]


_WAY = "array<struct<sibling: binary, right: boolean>>"


def node_rows(leaves: DataFrame, stride: int = STRIDE, reach: int = REACH) -> DataFrame:
    """The stored tree: tree, page (a bottom page), step, levels, way, next_step,
    subroot, root.

    Step 0 has the levels of the bottom page; each later step has the next
    ``reach`` levels of its way: the sibling (null where there is none) and
    whether the climbing node is the right one of the two. next_step is the
    link to the parent row, null at the root, where subroot and root are given.
    The ways are carried down from the root, page by page.
    """
    down: DataFrame | None = None
    bottom: list[DataFrame] = []
    for i, pages in enumerate(_built(leaves, stride)):  # a page's parent is always in an earlier table
        below = pages.filter("parent_page IS NULL").select(
            "*", F.array().cast(_WAY).alias("way"), F.lit(None).cast("binary").alias("subroot"), F.col("top").alias("root")
        )
        if down is not None:
            up = down.select(
                F.col("tree").alias("_tree"), F.col("stage").alias("_stage"), F.col("page").alias("_page"),
                F.col("levels").alias("_levels"), F.col("way").alias("_way"), F.col("subroot").alias("_subroot"), "root",
            )
            place = lambda l: F.call_function("shiftright", F.col("slot"), l)
            here = F.transform(
                "_levels",
                lambda level, l: F.struct(
                    F.try_element_at(level, place(l).bitwiseXOR(1) + 1).alias("sibling"),
                    (place(l).bitwiseAND(1) == 1).alias("right"),
                ),
            )
            joined = pages.join(
                up, [F.col("_tree") == F.col("parent_tree"), F.col("_stage") == F.col("parent_stage"), F.col("_page") == F.col("parent_page")]
            ).select(
                *pages.columns, F.concat(here, "_way").cast(_WAY).alias("way"),
                F.when((F.col("parent_tree") == CROWN) & (F.col("tree") != CROWN), F.col("top")).otherwise(F.col("_subroot")).alias("subroot"),
                "root",
            )
            below = joined.unionByName(below)
        stored = saved(below, f"merkle-down-{i}")
        down = stored if down is None else down.unionByName(stored)
        bottom.append(stored.filter(f"stage = 0 AND tree <> {CROWN}"))
    pages = bottom[0]
    for b in bottom[1:]:
        pages = pages.unionByName(b)
    size = F.size("way")
    cuts = F.when(size > 0, F.sequence(F.lit(1), size, F.lit(reach))).otherwise(F.array().cast("array<int>"))
    ways = F.concat(F.array(F.lit(None).cast(_WAY)), F.transform(cuts, lambda at: F.slice("way", at, reach)))
    rows = pages.select(
        "tree", "page", "levels", "subroot", "root", F.size(cuts).alias("last"), F.posexplode(ways).alias("step", "way")
    )
    top = F.col("step") == F.col("last")
    return rows.select(
        "tree", "page", "step", F.when(F.col("step") == 0, F.col("levels")).alias("levels"), "way",
        F.when(~top, F.col("step") + 1).alias("next_step"), F.when(top, F.col("subroot")).alias("subroot"),
        F.when(top, F.col("root")).alias("root"),
    )


#: One step: the siblings of the climbing node level by level, appended to the
#: proof and folded into the digest.
_CLIMB = """
WITH RECURSIVE climb (doc_id, leaf, tree, page, step, place, folded, proof, subroot, root) AS (
  SELECT doc_id, leaf, tree, page, 0, place, folded, X'', CAST(NULL AS BINARY), CAST(NULL AS BINARY) FROM {leaves}
  UNION ALL
  SELECT doc_id, leaf, tree, page, next_step, place, unhex(went.h), went.proof, subroot, root
  FROM (
    SELECT c.doc_id, c.leaf, c.tree, c.page, c.place, n.next_step, n.subroot, n.root,
      aggregate(
        coalesce(n.way, transform(n.levels, (level, l) -> named_struct(
          'sibling', try_element_at(level, (shiftright(c.place, l) ^ 1) + 1),
          'right', shiftright(c.place, l) & 1 = 1))),
        named_struct('h', lower(hex(c.folded)), 'proof', c.proof),
        (acc, s) -> named_struct(
          'h', sha2(concat(if(s.right, lower(hex(s.sibling)), ''), acc.h,
                           if(s.right, '', coalesce(lower(hex(s.sibling)), ''))), 256),
          'proof', concat(acc.proof, coalesce(s.sibling, X''))),
        acc -> acc) AS went
    FROM climb c JOIN {nodes} n ON c.tree = n.tree AND c.page = n.page AND c.step = n.step
  )
)
SELECT doc_id, leaf, folded, proof, subroot, root FROM climb WHERE step IS NULL
"""


def climb(leaves: DataFrame, nodes: DataFrame) -> DataFrame:
    """Climbs from every row of ``leaves`` (doc_id, leaf, tree, page, place,
    folded: the digest to start from) through ``nodes`` (as ``node_rows``):
    doc_id, leaf, folded, proof (sibling digests in order), subroot, root.

    The result is written before it returns, with the recursion's row limit
    off: all rows climb at once."""
    spark = leaves.sparkSession
    names = {"leaves": "_merkle_leaves", "nodes": "_merkle_nodes"}
    before = {k: spark.conf.get(k, None) for k in _LIMITS}
    leaves.createOrReplaceTempView(names["leaves"])
    nodes.createOrReplaceTempView(names["nodes"])
    try:
        spark.conf.set(_LIMITS[0], "-1")
        return saved(spark.sql(_CLIMB.format(**names)), "merkle-climbed")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
        for view in names.values():
            spark.catalog.dropTempView(view)


def manifest(docs: DataFrame, altered: Column | None = None, stride: int = STRIDE) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for every row.

    ``docs`` has doc_id, source, lang, n_chars and text; other columns are
    ignored. ``altered`` marks rows that are checked with n_chars raised by
    one (a null n_chars stays): their folded_root shows what a changed row
    leads to. A null field is ``-`` in its leaf; null languages form a tree of
    their own, the first, and null ids come first in theirs. Rows with the
    same id are ordered by leaf; repeated rows are leaves of their own. A
    single row is leaf, subroot and root at once, with the empty proof. An
    empty table gives an empty result.
    """
    cols = [F.col("doc_id").cast("bigint").alias("doc_id"), *[F.col(c).alias(c) for c in ("source", "lang", "n_chars", "text")]]
    base = docs.select(*cols)
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    changed = F.lit(False) if altered is None else F.coalesce(altered, F.lit(False))
    leaves = base.select(
        "doc_id", "lang", F.unhex(leaf_digest()).alias("leaf"),
        F.when(changed & F.col("n_chars").isNotNull(), F.unhex(leaf_digest(more))).alias("changed"),
    )
    placed = saved(_ranked(saved(leaves, "merkle-leaves")), "merkle-placed")
    nodes = saved(node_rows(placed, stride), "merkle-nodes") if not placed.isEmpty() else None
    if nodes is None:
        digests = [F.hex("leaf").alias(c) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")]
        return placed.select("doc_id", *digests, F.lit(True).alias("verified"))
    start = placed.select(
        "doc_id", "leaf", "tree", F.shiftright("pos", stride).alias("page"),
        F.col("pos").bitwiseAND((1 << stride) - 1).cast("int").alias("place"),
        F.coalesce("changed", "leaf").alias("folded"),
    )
    done = climb(start, nodes)
    text = lambda c: F.lower(F.hex(c))
    return done.select(
        "doc_id", text("leaf").alias("leaf"), text("subroot").alias("subroot"), text("root").alias("root"),
        F.sha2(text("proof"), 256).alias("proof_sha256"), text("folded").alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(read_documents(spark, sf_dir), tampered())


QUERIES = {"op13_merkle": op13_merkle}

# One level per recursion in DuckDB; a proof is gathered on the way.
ORACLE = {
    "op13_merkle": r"""
WITH RECURSIVE crc_byte AS (
  SELECT i AS b, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END, i::BIGINT) AS t
  FROM range(256) r(i)
), state(doc_id, spot, c) AS (
  SELECT DISTINCT doc_id, 1, 4294967295::BIGINT FROM documents WHERE doc_id IS NOT NULL
  UNION ALL
  SELECT s.doc_id, s.spot + 1, xor(t.t, s.c >> 8)
  FROM state s JOIN crc_byte t ON t.b = xor(s.c, ascii(substr(s.doc_id::VARCHAR, s.spot, 1))::BIGINT) & 255
  WHERE s.spot <= length(s.doc_id::VARCHAR)
), altered AS (
  SELECT doc_id FROM state WHERE spot = length(doc_id::VARCHAR) + 1 AND xor(c, 4294967295::BIGINT) % 7 = 0
), field AS (
  SELECT doc_id, lang, n_chars IS NOT NULL AND doc_id IN (SELECT doc_id FROM altered) AS changed,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    n_chars, coalesce(strlen(text) || ':' || text, '-') AS tail
  FROM documents
), leaf AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
    sha256(head || coalesce(strlen((n_chars + CASE WHEN changed THEN 1 ELSE 0 END)::VARCHAR) || ':'
      || (n_chars + CASE WHEN changed THEN 1 ELSE 0 END), '-') || tail) AS start
  FROM field
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id, leaf) - 1 AS pos,
    dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, row_number() OVER (ORDER BY lang NULLS FIRST, doc_id, leaf) AS id
  FROM leaf
), level(tree, l, nodes) AS (
  SELECT tree, 0, list(leaf ORDER BY pos) FROM placed GROUP BY tree
  UNION ALL
  SELECT tree, l + 1, list_transform(range(0, len(nodes), 2), lambda i: sha256(concat(nodes[i + 1], nodes[i + 2])))
  FROM level WHERE len(nodes) > 1
), sub AS (SELECT tree, nodes[1] AS subroot, l AS depth FROM level WHERE len(nodes) = 1),
crown(l, nodes) AS (
  SELECT 0, list(subroot ORDER BY tree) FROM sub
  UNION ALL
  SELECT l + 1, list_transform(range(0, len(nodes), 2), lambda i: sha256(concat(nodes[i + 1], nodes[i + 2])))
  FROM crown WHERE len(nodes) > 1
), steps AS (
  SELECT tree, l, nodes, false AS upper FROM level WHERE len(nodes) > 1
  UNION ALL
  SELECT s.tree, s.depth + c.l, c.nodes, true FROM sub s, crown c WHERE len(c.nodes) > 1
), climb(id, tree, l, h, proof) AS (
  SELECT id, tree, 0, start, '' FROM placed
  UNION ALL
  SELECT c.id, c.tree, c.l + 1,
    CASE WHEN a.spot % 2 = 1 THEN sha256(concat(a.sibling, c.h)) ELSE sha256(concat(c.h, a.sibling)) END,
    concat(c.proof, a.sibling)
  FROM climb c JOIN (
    SELECT id, l, spot, nodes[CASE WHEN spot % 2 = 1 THEN spot ELSE spot + 2 END] AS sibling FROM (
      SELECT p.id, s.l, s.nodes, CASE WHEN s.upper THEN p.tree >> (s.l - u.depth) ELSE p.pos >> s.l END AS spot
      FROM placed p JOIN steps s USING (tree) JOIN sub u USING (tree))
  ) a ON a.id = c.id AND a.l = c.l
), ended AS (SELECT id, max_by(h, l) AS folded_root, max_by(proof, l) AS proof FROM climb GROUP BY id)
SELECT p.doc_id, p.leaf, u.subroot, r.nodes[1] AS root, sha256(e.proof) AS proof_sha256, e.folded_root, e.folded_root = r.nodes[1] AS verified
FROM placed p JOIN sub u USING (tree) JOIN ended e USING (id), (SELECT nodes FROM crown WHERE len(nodes) = 1) r
"""
}
