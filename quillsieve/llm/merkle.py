"""A Merkle manifest of a dataset: leaves, subroots per group, one root and a proof per row.

Levels are built by a slot pivot: the children of a parent are the rows ``idx // fanout``
of one group, and conditional aggregates spread them into ``fanout`` slot columns. Joining
the slot columns in order gives the text the parent hashes; for a child, the slots before
its own and after it are its siblings. Proofs are then passed down, one join a level, from
the root to the leaves, so each leaf gets the list of (left, right) sibling texts from its
level up to the root without any group being gathered in one task.

Each level is a table a fanout times smaller than the one below; with ``n`` leaves there
are ``ceil(log(n) / log(fanout))`` levels, each one aggregate and, on the way down, one
join on (group, parent number): keys that are unique per parent, so a hot group spreads
over all tasks.

Rows and columns, defined for awkward input:

* a null column is ``-`` in a leaf; any other value is its UTF-8 byte count, ``:`` and its
  text, integers in decimal;
* leaves ascend by the order column (nulls first), ties by the leaf digest: repeated rows
  get the same leaf at neighbouring places, and any order of them gives the same result rows;
* groups are ordered nulls first, then bytewise by UTF-8 (Spark's string order);
* a group with one leaf has that leaf as its subroot; a dataset with one group has its
  subroot as root; an empty table gives no rows;
* extra columns are ignored; names this module adds inside start with ``_mk``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillsieve.llm.common import table
from quillsieve.operators.position import with_ordered_index
from quillsieve.session import materialise
from quillsieve.sizing import small_side

FANOUT = 8


def digest(*parts: Column) -> Column:
    """H: lowercase hex SHA-256 of the parts joined; null parts add nothing."""
    return F.sha2(F.concat_ws("", *parts), 256)


def field(value: Column) -> Column:
    """A leaf's field: ``-`` for null, else the UTF-8 byte count, ``:`` and the text of the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    """The leaf digest of the given values, in order."""
    return digest(*[field(v) for v in values])


def _slots(fanout: int) -> list[str]:
    return [f"_mk_c{k}" for k in range(fanout)]


def _levels(nodes: DataFrame, fanout: int) -> list[DataFrame]:
    """Levels from ``nodes`` (``_mk_g, _mk_i, _mk_h, _mk_n``) up until each group has one node.

    ``_mk_n`` is the number of nodes of the row's group at its level. Level ``L + 1`` holds
    parents with their slot columns; groups with one node stop rising.
    """
    levels = [nodes]
    slots = _slots(fanout)
    while True:
        rising = levels[-1].where(F.col("_mk_n") > 1)
        # Group sizes shrink by the fanout a level; one row per group decides whether to go on.
        if rising.limit(1).count() == 0:
            return levels
        slot = F.col("_mk_i") % fanout
        parents = rising.groupBy("_mk_g", (F.col("_mk_i") / F.lit(fanout)).cast("long").alias("_mk_i")).agg(
            F.first("_mk_n").alias("_mk_below"),
            *[F.max(F.when(slot == k, F.col("_mk_h"))).alias(c) for k, c in enumerate(slots)],
        )
        parents = parents.select(
            "_mk_g",
            "_mk_i",
            digest(*[F.col(c) for c in slots]).alias("_mk_h"),
            ((F.col("_mk_below") + fanout - 1) / F.lit(fanout)).cast("long").alias("_mk_n"),
            *slots,
        )
        levels.append(materialise(parents, "merkle-level"))


def _passed_down(levels: list[DataFrame], tops: DataFrame, fanout: int, carry: Sequence[str]) -> DataFrame:
    """For the nodes of ``levels[0]``: ``_mk_steps`` (sibling texts to the top) and ``carry``.

    ``tops`` gives, per group, the steps above the group's top node and the ``carry`` columns.
    """
    slots = _slots(fanout)
    above = None
    for depth in range(len(levels) - 1, -1, -1):
        nodes = levels[depth]
        top = nodes.where(F.col("_mk_n") == 1)
        top = top.join(tops.withColumnRenamed("_mk_g", "_mk_tg"), top["_mk_g"].eqNullSafe(F.col("_mk_tg"))).drop("_mk_tg")
        here = top.select(*nodes.columns, "_mk_steps", *carry)
        if above is not None:
            up = above.select(
                F.col("_mk_g").alias("_mk_pg"),
                F.col("_mk_i").alias("_mk_pi"),
                F.col("_mk_steps").alias("_mk_up"),
                *carry,
                *[F.col(c).alias(f"_mk_p{k}") for k, c in enumerate(slots)],
            )
            low = nodes.where(F.col("_mk_n") > 1)
            joined = low.join(
                up,
                low["_mk_g"].eqNullSafe(up["_mk_pg"]) & ((low["_mk_i"] / F.lit(fanout)).cast("long") == up["_mk_pi"]),
            )
            own = F.col("_mk_i") % fanout
            left = F.concat_ws("", *[F.when(own > k, F.col(f"_mk_p{k}")) for k in range(fanout)])
            right = F.concat_ws("", *[F.when(own < k, F.col(f"_mk_p{k}")) for k in range(fanout)])
            step = F.array(F.struct(left.alias("l"), right.alias("r")))
            inner = joined.select(
                *[joined[c] for c in nodes.columns],
                F.concat(step, F.col("_mk_up")).alias("_mk_steps"),
                *carry,
            )
            here = here.unionByName(inner)
        above = here if depth == 0 else materialise(here, "merkle-down")
    return above


def fold(start: Column, steps: Column) -> Column:
    """The root recomputed from a leaf digest and its steps: H(left, node, right) a level."""
    return F.aggregate(steps, start, lambda acc, s: digest(s["l"], acc, s["r"]))


def proof(steps: Column) -> Column:
    """H of all siblings, level by level upwards, left to right within a level."""
    return digest(F.array_join(F.transform(steps, lambda s: F.concat(s["l"], s["r"])), ""))


def manifest(
    df: DataFrame,
    leaf_cols: Sequence[str],
    group_col: str,
    order_col: str,
    fanout: int = FANOUT,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Every row of ``df`` with ``leaf``, ``subroot``, ``root`` and ``steps``.

    Only the columns named in ``keep`` (all by default) are carried through the sort and the
    joins; leave out wide ones such as texts once their digests are taken.

    ``steps`` lists, from the leaf's level up to the root, the concatenated digests of the
    siblings left and right of the node on the path (through the group's subroot). Rows keep
    all their columns, but for any named like those added, which are replaced; the first of
    repeated names is the one used.
    """
    names = df.columns
    inner = {c: f"_mk_in{i}" for i, c in reversed(list(enumerate(names)))}
    rows = df.toDF(*[f"_mk_in{i}" for i in range(len(names))])
    rows = rows.withColumn("leaf", leaf(*[F.col(inner[c]) for c in leaf_cols]))
    kept_names = [c for c in (names if keep is None else keep)]
    rows = rows.select(*{inner[c] for c in (*kept_names, group_col, order_col)}, "leaf")
    keyed = rows.withColumn("_mk_g", F.col(inner[group_col]))
    order_col = inner[order_col]
    placed = with_ordered_index(keyed, [F.col(order_col).asc_nulls_first(), F.col("leaf")], by=["_mk_g"], name="_mk_i")
    placed = materialise(placed, "merkle-leaves")
    counts = placed.groupBy("_mk_g").agg(F.count(F.lit(1)).alias("_mk_n"))
    # One row per group; the join partner is checked for size before it is broadcast.
    counts = small_side(counts).withColumnRenamed("_mk_g", "_mk_cg")
    base = placed.join(counts, placed["_mk_g"].eqNullSafe(counts["_mk_cg"])).select("_mk_g", "_mk_i", F.col("leaf").alias("_mk_h"), "_mk_n")
    group_levels = _levels(base, fanout)

    # Subroots: the one node each group keeps, wherever it stopped rising.
    subroots = None
    for level in group_levels:
        one = level.where(F.col("_mk_n") == 1).select(F.col("_mk_g").alias("_mk_lang"), "_mk_h")
        subroots = one if subroots is None else subroots.unionByName(one)
    # One row per group: the top tree is ordered in one task, as the groups are few.
    order = Window.orderBy(F.col("_mk_lang").asc_nulls_first())
    subroots = materialise(subroots, "merkle-subroots")
    top_nodes = subroots.select(
        F.lit(0).alias("_mk_g"),
        (F.row_number().over(order) - 1).cast("long").alias("_mk_i"),
        "_mk_h",
        F.count(F.lit(1)).over(Window.partitionBy(F.lit(0))).cast("long").alias("_mk_n"),
        "_mk_lang",
    )
    top_nodes = materialise(top_nodes, "merkle-top")
    top_levels = _levels(top_nodes.drop("_mk_lang"), fanout)
    top_levels[0] = top_nodes
    none = F.filter(F.array(F.struct(F.lit("").alias("l"), F.lit("").alias("r"))), lambda s: F.lit(False))
    root = top_levels[-1].select(F.lit(0).alias("_mk_g"), F.col("_mk_h").alias("root"), none.alias("_mk_steps"))
    top_down = _passed_down(top_levels, root, fanout, ["root"])
    group_tops = top_down.select(F.col("_mk_lang").alias("_mk_g"), "_mk_steps", "root", F.col("_mk_h").alias("subroot"))
    group_tops = small_side(group_tops)
    down = _passed_down(group_levels, group_tops, fanout, ["root", "subroot"])
    down = down.select(F.col("_mk_g").alias("_mk_dg"), F.col("_mk_i").alias("_mk_di"), "_mk_steps", "root", "subroot")
    out = placed.join(down, placed["_mk_g"].eqNullSafe(down["_mk_dg"]) & (placed["_mk_i"] == down["_mk_di"]))
    added = ("leaf", "subroot", "root", "steps", "position")
    kept = [F.col(inner[c]).alias(c) for c in dict.fromkeys(kept_names) if c not in added]
    return out.select(*kept, "leaf", "subroot", "root", F.col("_mk_steps").alias("steps"), F.col("_mk_i").alias("position"))


#: Fixed letters of the tampering: ASCII upper case and its lower case.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of all documents by language; every third id (by crc32) has its text lower-cased and is checked."""
    docs = table(spark, sf_dir, "documents")
    tampered = (F.crc32(F.col("doc_id").cast("string")) % 3) == 0
    text = F.when(tampered, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))
    # Both digests are taken in the scan; the texts go no further.
    docs = docs.select(*LEAF_COLUMNS, leaf(*[text if c == "text" else F.col(c) for c in LEAF_COLUMNS]).alias("changed"))
    made = manifest(docs, LEAF_COLUMNS, "lang", "doc_id", keep=["doc_id", "changed"])
    changed = F.col("changed")
    return made.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof(F.col("steps")).alias("proof_sha256"),
        fold(changed, F.col("steps")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES = {"op13_merkle_manifest": op13_merkle_manifest}
ORACLES: dict[str, str] = {}
