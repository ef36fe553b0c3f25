"""Repair of conversation structure by depth-first branch-and-bound.

Rows of a conversation, in order, are kept, given a new role (user or assistant), deleted,
or have empty user or assistant rows inserted before them, so that the role initials read
``(s?(ua)+)?``: nothing, or an optional system row and then user and assistant in turns.
Costs are those of ``COSTS``; a truncated row that stays costs one more; blank and duplicate
rows must go. Of the cheapest repairs the one whose audit (the edits' initials in order) is
least in ASCII is chosen.

The search (``cheapest``) walks the tree of edits depth first with an explicit stack. Each
node is (row, grammar state, cost, audit so far). It is cut when its cost plus a lower bound
of the rows left exceeds the
incumbent's, or equals it with an audit that can no longer come first. The bound of a node
is the least cost of the rows left from its state (a backward pass over rows and states that
ignores audits), so it is met, and the first dive finds a cheapest repair. A table per (row,
state) keeps the best (cost, audit) that reached it; a node that is not better is dropped:
with equal cost and the same number of rows behind, two audits differ before either ends,
so the smaller one stays smaller whatever follows. When the stack is empty the incumbent is
proved optimal.

Faults and counts are DataFrame work; the search runs per conversation in ``applyInPandas``,
as a conversation's repair is one sequence: a task holds the rows of one conversation at a
time.

Awkward rows: null role or text is one space (so a null text is blank); null turns sort
first, and rows with equal turns by role and text; a null conversation id is one
conversation; a conversation that loses all rows has zero counts, an empty audit and the
digest of the empty string. Extra input columns are ignored.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillsieve.llm.common import table

# Fixed values of the task: edit costs and the extra cost of a truncated row that stays.
COSTS = {"K": 0, "R": 2, "D": 3, "I": 2}
TRUNCATED_EXTRA = 1
USER, ASSISTANT = "user", "assistant"

# Grammar states of (s?(ua)+)?: start, after s, after u, after a. Start and after a accept.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
ACCEPTING = {START, AFTER_A}
#: Initial read in a state -> next state.
MOVES = {START: {"s": AFTER_S, "u": AFTER_U}, AFTER_S: {"u": AFTER_U}, AFTER_U: {"a": AFTER_A}, AFTER_A: {"u": AFTER_U}}
#: The role an insertion or a new role must take in a state (the grammar leaves one choice).
NEEDED = {START: USER, AFTER_S: USER, AFTER_U: ASSISTANT, AFTER_A: USER}

BLANK, DUPLICATE, TRUNCATED, FINE = "blank", "duplicate", "truncated", ""


def _initial(role: str) -> str:
    return role[:1]


def _suffix_bounds(rows: list[tuple[str, str]], must_go: list[bool], extra: list[int]) -> list[list[float]]:
    """Least cost of the rows from ``i`` on, starting in each state: a lower bound that is met.

    With it the search goes down a cheapest path first and cuts every other one at once, so it
    visits a few nodes a row; ties in cost are still settled by the audits.
    """
    n = len(rows)
    bounds: list[list[float]] = [[0.0] * 4 for _ in range(n + 1)]
    for i in range(n, -1, -1):
        here = [0.0 if (i == n and q in ACCEPTING) else float("inf") for q in range(4)]
        if i < n:
            after = bounds[i + 1]
            for q in range(4):
                options = [COSTS["D"] + after[q]]
                if not must_go[i]:
                    moved = MOVES[q].get(_initial(rows[i][0]))
                    if moved is not None:
                        options.append(extra[i] + after[moved])
                    if rows[i][0] != NEEDED[q]:
                        options.append(COSTS["R"] + extra[i] + after[MOVES[q][_initial(NEEDED[q])]])
                here[q] = min(options)
        for _ in range(4):  # insertions stay at row i; four rounds settle all four states
            for q in range(4):
                here[q] = min(here[q], COSTS["I"] + here[MOVES[q][_initial(NEEDED[q])]])
        bounds[i] = here
    return bounds


def cheapest(rows: list[tuple[str, str]]) -> tuple[int, str]:
    """Least (cost, audit) for rows of (role, fault); see the module."""
    n = len(rows)
    must_go = [fault in (BLANK, DUPLICATE) for _, fault in rows]
    extra = [TRUNCATED_EXTRA if fault == TRUNCATED else 0 for _, fault in rows]
    bound = _suffix_bounds(rows, must_go, extra)
    best_cost, best_audit = COSTS["D"] * n, "D" * n  # deleting all is always a repair
    seen: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, START, 0, "")]
    while stack:
        i, state, cost, audit = stack.pop()
        low = cost + bound[i][state]
        # At equal cost a node can only win if its audit sorts first (a prefix of the incumbent's
        # included); one at or past the incumbent's cannot.
        if low > best_cost or (low == best_cost and not audit < best_audit):
            continue
        here = seen.get((i, state))
        if here is not None and here <= (cost, audit):
            continue
        seen[(i, state)] = (cost, audit)
        if i == n and state in ACCEPTING and (cost, audit) < (best_cost, best_audit):
            best_cost, best_audit = cost, audit
        children = []
        need = NEEDED[state]
        children.append((i, MOVES[state][_initial(need)], cost + COSTS["I"], audit + "I"))
        if i < n:
            role = rows[i][0]
            children.append((i + 1, state, cost + COSTS["D"], audit + "D"))
            if not must_go[i]:
                moved = MOVES[state].get(_initial(role))
                if moved is not None:
                    children.append((i + 1, moved, cost + extra[i], audit + "K"))
                if role != need:
                    children.append((i + 1, MOVES[state][_initial(need)], cost + COSTS["R"] + extra[i], audit + "R"))
        # The most promising child is popped first.
        children.sort(key=lambda c: (c[2] + bound[c[0]][c[1]], c[3]), reverse=True)
        stack.extend(children)
    return best_cost, best_audit


def repaired(rows: list[tuple[str, str]], audit: str) -> list[tuple[str, str]]:
    """(role, text) of the rows after the edits of ``audit``."""
    out, i, state = [], 0, START
    for edit in audit:
        if edit == "D":
            i += 1
            continue
        if edit == "I":
            role, text = NEEDED[state], ""
        else:
            role, text = rows[i]
            if edit == "R":
                role = NEEDED[state]
            i += 1
        out.append((role, text))
        state = MOVES[state][_initial(role)]
    return out


def _search(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("_rp_pos")
    roles, texts, faults = list(pdf["_rp_role"]), list(pdf["_rp_text"]), list(pdf["_rp_fault"])
    cost, audit = cheapest(list(zip(roles, faults)))
    rows = repaired(list(zip(roles, texts)), audit)
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in rows).encode("utf-8", "surrogatepass")).hexdigest()
    conv = pdf["_rp_conv"].iloc[0]
    return pd.DataFrame(
        {
            "_rp_conv": pd.array([None if pd.isna(conv) else int(conv)], dtype="Int64"),
            "cost": [cost],
            "audit": [audit],
            "repaired_sha256": [digest],
        }
    )


def faults(rows: DataFrame, conv: str, order: list[Column], role: str, text: str) -> DataFrame:
    """Each row's first fault and its place (``_rp_pos``) in its conversation."""
    place = Window.partitionBy(conv).orderBy(*order)
    first_of = Window.partitionBy(conv, role, text).orderBy(*order)
    visible = F.regexp_extract(F.col(text), r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*$", 1)
    fault = (
        F.when(visible == "", F.lit(BLANK))
        .when(F.row_number().over(first_of) > 1, F.lit(DUPLICATE))
        .when(~visible.rlike(r"^[.!?]$"), F.lit(TRUNCATED))
        .otherwise(F.lit(FINE))
    )
    return rows.select("*", fault.alias("_rp_fault"), F.row_number().over(place).alias("_rp_pos"))


def damaged(convs: DataFrame) -> DataFrame:
    """Rows after the damage keyed by crc32 of ``conv_id:turn``; null strings are one space."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = convs.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text"), F.lit(" ")).alias("text"),
        (F.crc32(key) % 20).alias("_rp_kind"),
    )
    kind = F.col("_rp_kind")
    rows = rows.where(kind != 0).select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit(USER)).otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_rp_copy"),
    )
    return rows.drop("_rp_copy")


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Per conversation of ``rows``: fault counts, ``gaps``, ``illegal`` pairs, ``cost``, ``audit``, ``repaired_sha256``.

    ``rows`` are taken as they are (no damage); roles and texts must not be null.
    """
    base = rows.select(
        F.col(conv).alias("_rp_conv"), F.col(turn).alias("_rp_turn"), F.col(role).alias("_rp_role"), F.col(text).alias("_rp_text")
    )
    order = [F.col("_rp_turn").asc_nulls_first(), F.col("_rp_role"), F.col("_rp_text")]
    marked = faults(base, "_rp_conv", order, "_rp_role", "_rp_text")
    pair = F.concat(F.substring(F.lag("_rp_role").over(Window.partitionBy("_rp_conv").orderBy("_rp_pos")), 1, 1), F.substring("_rp_role", 1, 1))
    marked = marked.withColumn("_rp_bad", (pair.isNotNull() & ~pair.isin("su", "ua", "au")).cast("long"))
    counts = marked.groupBy("_rp_conv").agg(
        F.coalesce(F.max("_rp_turn") - F.min("_rp_turn") + 1 - F.countDistinct("_rp_turn"), F.lit(0)).cast("long").alias("gaps"),
        F.sum((F.col("_rp_fault") == BLANK).cast("long")).alias("blank"),
        F.sum((F.col("_rp_fault") == DUPLICATE).cast("long")).alias("duplicate"),
        F.sum((F.col("_rp_fault") == TRUNCATED).cast("long")).alias("truncated"),
        F.sum("_rp_bad").alias("illegal"),
    )
    searched = marked.select("_rp_conv", "_rp_pos", "_rp_role", "_rp_text", "_rp_fault").groupBy("_rp_conv").applyInPandas(
        _search, "_rp_conv long, cost long, audit string, repaired_sha256 string"
    )
    searched = searched.withColumnRenamed("_rp_conv", "_rp_sconv")
    joined = counts.join(searched, counts["_rp_conv"].eqNullSafe(searched["_rp_sconv"]))
    return joined.select(F.col("_rp_conv").alias(conv), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation damaged as the contract says, then counted and repaired."""
    convs = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    fixed = repair(damaged(convs))
    ids = convs.select(F.col("conv_id").alias("_rp_id")).distinct()
    out = ids.join(fixed, ids["_rp_id"].eqNullSafe(fixed["conv_id"]), "left")
    zero = F.lit(0).cast("long")
    return out.select(
        F.col("_rp_id").alias("conv_id"),
        *[F.coalesce(F.col(c), zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce(F.col("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.col("repaired_sha256"), F.lit(EMPTY_SHA256)).alias("repaired_sha256"),
    )


QUERIES = {"op12_conversation_repair": op12_conversation_repair}
ORACLES: dict[str, str] = {}
