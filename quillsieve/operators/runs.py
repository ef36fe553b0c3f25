"""Statistics and listings of labelling runs, from their parsed result lines.

Lines carry ``run_id`` and ``line_no``, which orders the lines of a run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillsieve.functions.answers import score_for_sorting, score_number
from quillsieve.functions.display import model_key
from quillsieve.operators.position import with_ordered_index
from quillsieve.sizing import small_side

#: Rows of a page, scores that are counted.
PER_PAGE = 10
SCORE_BINS = range(6)


def cap_lines(lines: DataFrame, cap: int | None = None) -> DataFrame:
    """All lines, or those up to the one that completes ``cap`` complete rows of its run.

    Complete rows are numbered by a sort of their keys, so a run of any size is shared by tasks.
    """
    if cap is None:
        return lines
    complete = lines.filter("complete").select("run_id", "line_no")
    numbered = with_ordered_index(complete, ["line_no"], by=["run_id"], name="_position")
    last = numbered.filter(F.col("_position") == cap - 1).select("run_id", F.col("line_no").alias("_last"))
    return lines.join(small_side(last), "run_id", "left").filter(F.col("_last").isNull() | (F.col("line_no") <= F.col("_last"))).drop("_last")


def requests(lines: DataFrame, cap: int | None = None) -> DataFrame:
    """Complete rows of every run, all or at most ``cap`` of each, in the fields the explorer shows."""
    return cap_lines(lines, cap).filter("complete")


def binned_score() -> Column:
    """A score that is a JSON number equal to one of the bins, else null."""
    number = score_number(F.col("score_raw"), F.col("score_json_type"))
    return F.when(number.isin([float(b) for b in SCORE_BINS]), number.cast("int"))


def run_summaries(lines: DataFrame, cap: int | None = None) -> DataFrame:
    """One row per run with at least one complete row, newest first.

    The majority language counts every line with a model and a language, also incomplete ones.
    """
    seen = cap_lines(lines, cap)
    languages = seen.groupBy("run_id", "language").agg(F.count(F.lit(1)).alias("n"))
    majority = languages.groupBy("run_id").agg(F.min_by("language", F.struct(-F.col("n"), F.col("language"))).alias("language"))
    counted = F.when(F.col("complete"), binned_score())
    thinking_order = F.when(F.col("has_thinking"), F.col("line_no"))
    totals = seen.groupBy("run_id").agg(
        F.max_by("model", "line_no").alias("model_name"),
        F.count_if("complete").alias("num_requests"),
        F.array(*[F.count_if(F.coalesce(counted == b, F.lit(False))) for b in SCORE_BINS]).alias("score_distribution"),
        F.min("file_ts").alias("creation_ts"),
        F.max_by("thinking", thinking_order).alias("thinking"),
    )
    named = totals.filter((F.col("num_requests") > 0) & (F.coalesce(F.col("model_name"), F.lit("")) != ""))
    return (
        named.join(majority, "run_id")
        .select(
            model_key(F.col("model_name"), F.col("language"), F.col("run_id")).alias("model_key"),
            "model_name", "language", F.col("run_id").alias("dataset_id"), "num_requests", "score_distribution", "creation_ts", "thinking",
        )
        .orderBy(F.desc("creation_ts"), "model_key")
    )


def by_model(summaries: DataFrame) -> DataFrame:
    """Runs listed under their model: the model's totals beside each of its runs."""
    totals = summaries.groupBy("model_name").agg(F.count(F.lit(1)).alias("model_runs"), F.sum("num_requests").alias("model_requests"))
    return summaries.join(totals, "model_name").orderBy("model_name", F.desc("creation_ts"), "model_key")


def score_histogram(rows: DataFrame, by: Sequence[str] = ("run_id",)) -> DataFrame:
    """Rows per bin 0..5 with empty bins at zero; other scores are not counted."""
    score = binned_score()
    counts = rows.groupBy(*by).agg(F.array(*[F.count_if(F.coalesce(score == b, F.lit(False))) for b in SCORE_BINS]).alias("_bins"))
    return counts.select(*by, F.posexplode("_bins").alias("score", "n"))


def score_counts(rows: DataFrame, by: Sequence[str] = ("run_id",)) -> DataFrame:
    """Rows per distinct score as written; equal numbers are one score, text is another."""
    number = score_number(F.col("score_raw"), F.col("score_json_type"))
    key = F.coalesce(number.cast("string"), F.col("score_raw"))
    return rows.groupBy(*by, number.isNotNull().alias("is_number"), key.alias("score")).agg(F.count(F.lit(1)).alias("n"))


def listing_order(sort_by: str | None = None, order: str = "desc") -> list[Column]:
    """Order of a run's rows: by score with ties in line order, or as they were written."""
    if sort_by is None:
        return [F.col("line_no")]
    if sort_by != "score" or order not in ("asc", "desc"):
        raise ValueError(f"cannot sort by {sort_by} {order}")
    score = score_for_sorting(F.col("score_raw"), F.col("score_json_type"))
    return [score.desc() if order == "desc" else score.asc(), F.col("line_no")]


def _numbered(rows: DataFrame, sort_by: str | None, order: str, per_page: int) -> DataFrame:
    """Keys of all rows with their score for sorting, sample number and page.

    Only keys are sorted; ``run_id`` and ``line_no`` together are unique.
    """
    keys = rows.select("run_id", "line_no", score_for_sorting(F.col("score_raw"), F.col("score_json_type")).alias("sort_score"))
    by = listing_order(sort_by, order)
    if sort_by is not None:
        by = [F.col("sort_score").desc() if order == "desc" else F.col("sort_score").asc(), F.col("line_no")]
    indexed = with_ordered_index(keys, by, by=["run_id"], name="_position")
    return indexed.withColumns(
        {"sample_no": F.col("_position") + 1, "page": (F.floor(F.col("_position") / F.lit(per_page)) + 1)}
    ).drop("_position")


def pages(rows: DataFrame, sort_by: str | None = None, order: str = "desc", per_page: int = PER_PAGE) -> DataFrame:
    """Every row with its sample number and page within its run, both from 1."""
    numbered = _numbered(rows, sort_by, order, per_page)
    if sort_by is None:
        numbered = numbered.drop("sort_score")
    return rows.join(numbered, ["run_id", "line_no"])


def one_page(rows: DataFrame, run_id: str, page: int = 1, sort_by: str | None = None, order: str = "desc", per_page: int = PER_PAGE) -> DataFrame:
    """Rows of one page of a run, found by position whichever page it is."""
    if page < 1:
        raise ValueError("pages count from 1")
    own = rows.filter(F.col("run_id") == run_id)
    # A page's keys are few, so they are sent to the rows.
    wanted = F.broadcast(_numbered(own, sort_by, order, per_page).filter(F.col("page") == page).select("run_id", "line_no", "sample_no"))
    return own.join(wanted, ["run_id", "line_no"]).orderBy("sample_no").select(*rows.columns)


def page_counts(rows: DataFrame, per_page: int = PER_PAGE) -> DataFrame:
    """Rows and pages of each run."""
    return rows.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("num_requests"), F.ceil(F.count(F.lit(1)) / F.lit(per_page)).alias("total_pages")
    )


def search(rows: DataFrame, query: str, columns: Sequence[str] = ("reasoning", "input_text")) -> DataFrame:
    """Rows holding the query in one of the columns, in any case. An empty query keeps all."""
    wanted = F.lower(F.lit(query))
    found = F.lit(False)
    for c in columns:
        found = found | F.coalesce(F.contains(F.lower(F.col(c)), wanted), F.lit(False))
    return rows if query == "" else rows.filter(found)
