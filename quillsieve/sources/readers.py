"""Scans: web documents, papers, result files of runs."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillsieve.functions import text
from quillsieve.functions.answers import as_keywords, as_text, json_type, strict_object
from quillsieve.operators.position import file_row_counts, take_rows
from quillsieve.schemas import PAPER, RUN_LINE, SCORE_RESULT
from quillsieve.session import materialise
from quillsieve.sizing import small_side, spread


def stored_tables(spark: SparkSession, folder: str, glob: str) -> bool:
    """Whether the pattern names folders: tables kept as a folder of part files."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{glob}")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return any(entry.isDirectory() for entry in found or ())


def read_parquet_folder(spark: SparkSession, folder: str, glob: str = "*.parquet") -> DataFrame:
    """All parquet files of a folder that match the pattern, and those of its folders that do."""
    if stored_tables(spark, folder, glob):
        # A filter on names looks at files only, so the pattern becomes a part of the path.
        return spark.read.parquet(f"{folder}/{glob}")
    return spark.read.option("pathGlobFilter", glob).parquet(folder)


def entry_of(spark: SparkSession, folder: str, file_path: Column) -> Column:
    """The file or folder right below ``folder`` that a file path leads through."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    full = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toUri().getPath()
    depth = len([part for part in full.split("/") if part])
    parts = F.split(F.regexp_replace(file_path, "^[^/:]+:(?://[^/]*)?/+|^/+", ""), "/")
    # Paths are URIs; a plus sign in one is a plus sign.
    return F.url_decode(F.replace(F.element_at(parts, depth + 1), F.lit("+"), F.lit("%2B")))


def read_dataset(spark: SparkSession, name: str, config: str, split: str = "train") -> DataFrame:
    """A dataset kept as ``name/config/split``."""
    return read_parquet_folder(spark, f"{name}/{config}/{split}")


def read_first_rows(spark: SparkSession, files: Sequence[str], n: int, order_by: Sequence[str]) -> DataFrame:
    """The first ``n`` rows of the given files in the given order."""
    return take_rows(spark.read.parquet(*files), n, order_by)


def read_with_source(spark: SparkSession, folder: str, glob: str = "*.parquet") -> DataFrame:
    """Parquet rows with the name of the file they come from, less its ending, in ``source_file``.

    Rows of a table kept as a folder of part files have the folder's name.
    """
    scan = read_parquet_folder(spark, folder, glob)
    tables = stored_tables(spark, folder, glob)
    file = entry_of(spark, folder, F.col("_metadata.file_path")) if tables else F.col("_metadata.file_name")
    return scan.select("*", F.regexp_replace(file, r"\.parquet$", "").alias("source_file"))


def read_csv_records(spark: SparkSession, path: str, schema: T.StructType, header: bool = True, quote: str = '"', escape: str = '"') -> DataFrame:
    """CSV whose quoted fields may hold line breaks, read by as many tasks as the files have splits.

    Files are read as lines by split, like any text. Quote characters are counted per line,
    summed per split, and a running sum over the splits of a file (a table of one row a split)
    tells each split whether it begins inside quotes; within a split a running sum does the
    same for each line. A line that begins outside quotes starts a record; the others join the
    record before them, which may have begun in an earlier split. Lines are then grouped by
    record, one shuffle of the text, and each record is parsed by ``from_csv``. With ``escape``
    equal to ``quote`` a doubled quote counts twice and leaves the parity as it is. Lines end at
    ``\n`` only, so a quoted ``\r\n`` stays as it was; a ``\r`` ending a record is dropped. Blank
    records are skipped; with ``header`` the first record of each file is.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_seq"),
        F.col("value").alias("_line"),
    )
    lines = lines.withColumn("_quotes", F.length("_line") - F.length(F.replace(F.col("_line"), F.lit(quote), F.lit(""))))
    lines = materialise(lines, "csv-lines")
    # One row a split: its quote count, first line and last line that starts a record are found below.
    in_file = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    in_split = Window.partitionBy("_file", "_block").orderBy("_seq").rowsBetween(Window.unboundedPreceding, -1)
    splits = lines.groupBy("_file", "_block").agg(F.sum("_quotes").alias("_q"), F.min("_seq").alias("_first"))
    splits = splits.select("*", F.coalesce(F.sum("_q").over(in_file), F.lit(0)).alias("_q_before"))
    splits = small_side(splits.drop("_q"))
    placed = lines.join(splits, ["_file", "_block"])
    inside = (F.col("_q_before") + F.coalesce(F.sum("_quotes").over(in_split), F.lit(0))) % 2 == 1
    placed = placed.select("*", (~inside).alias("_starts"))
    # The last record start of each split, carried into the splits after it that begin inside a record.
    last = placed.where("_starts").groupBy("_file", "_block").agg(F.max("_seq").alias("_last"))
    carried = splits.select("_file", "_block").join(last, ["_file", "_block"], "left")
    carried = small_side(carried.select("_file", "_block", F.last("_last", ignorenulls=True).over(in_file).alias("_carried")))
    upto = Window.partitionBy("_file", "_block").orderBy("_seq").rowsBetween(Window.unboundedPreceding, 0)
    own = F.max(F.when(F.col("_starts"), F.col("_seq"))).over(upto)
    keyed = placed.join(carried, ["_file", "_block"]).select(
        "_file", "_seq", "_line", F.coalesce(own, F.col("_carried")).alias("_record"), ((F.col("_block") == 0) & (F.col("_seq") == F.col("_first"))).alias("_top")
    )
    records = keyed.where(F.col("_record").isNotNull()).groupBy("_file", "_record").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_seq", "_line"))), lambda x: x["_line"]), "\n").alias("_text"),
        F.max("_top").alias("_top"),
    )
    records = records.withColumn("_text", F.regexp_replace("_text", "\r$", ""))
    records = records.where(F.col("_text") != "")
    if header:
        records = records.where(~F.col("_top"))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = F.from_csv(F.col("_text"), ddl, {"quote": quote, "escape": escape})
    return records.select(parsed.alias("_row")).select("_row.*")


def read_papers(spark: SparkSession, path: str, schema: T.StructType = PAPER, multi_line: bool = True) -> DataFrame:
    """Papers from CSV with a header. An empty field is null, quoted or not.

    Quoted line breaks need ``multi_line``: records are then put together from lines read by
    split (``read_csv_records``), so a large file is still read by many tasks.
    """
    if multi_line:
        rows = read_csv_records(spark, path, schema)
    else:
        reader = spark.read.schema(schema).option("header", True).option("escape", '"').option("enforceSchema", False)
        rows = reader.csv(path)
    strings = [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]
    return rows.withColumns({name: F.nullif(F.col(name), F.lit("")) for name in strings})


def total_examples(spark: SparkSession, folder: str, glob: str = "*.parquet") -> DataFrame:
    """Parquet files by path with their number of rows, from the file footers."""
    return file_row_counts(read_parquet_folder(spark, folder, glob)).orderBy("file_path")


def read_results(spark: SparkSession, folder: str, schema: T.StructType = SCORE_RESULT) -> DataFrame:
    """Result rows of a labelling or rewriting job, with their ``run_id``.

    The schema names ``run_id`` because a key of digits would otherwise be read as a number.
    """
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("run_id", T.StringType())])).json(folder)


# Keys a result line must hold, in the order they are looked up.
_LINE_KEYS = ("model", "language", "score", "reasoning", "input_text", "thinking", "keywords")


def _run_line(raw: str) -> tuple:
    line = strict_object(raw)
    if line is None:
        return (False, False, False, *[None] * 9)
    held = [key in line for key in _LINE_KEYS]
    score, kind = as_text(line.get("score")), json_type(line["score"]) if "score" in line else None
    if "score_raw" in line and "score_json_type" in line:
        # Our own results keep the score as the model wrote it beside the number.
        score, kind = as_text(line["score_raw"]), as_text(line["score_json_type"])
    return (
        all(held[:2]),
        all(held[:6]),
        all(held),
        as_text(line.get("model")),
        as_text(line.get("language")),
        score,
        kind,
        as_text(line.get("reasoning")),
        as_text(line.get("input_text")),
        as_text(line.get("generated_text", "")),
        as_text(line.get("thinking")),
        as_keywords(line.get("keywords")),
    )


#: Characters of lines parsed together: a batch's fields are never all held beside its lines.
PARSED_CHARS = 1024 * 1024


def _in_parts(raw: pd.Series) -> Iterator[list[str | None]]:
    """The lines of a batch in lists of a bounded length; a longer line is a list of its own."""
    part, size = [], 0
    for line in raw:
        length = len(line or "")
        if part and size + length > PARSED_CHARS:
            yield part
            part, size = [], 0
        part.append(line)
        size += length
    yield part


@F.pandas_udf(RUN_LINE)
def parse_run_line(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """Fields of one result line, with flags for how far its keys are complete."""
    for raw in batches:
        for part in _in_parts(raw):
            yield pd.DataFrame([_run_line(r) for r in part], columns=RUN_LINE.fieldNames())


def run_lines(raw: DataFrame, value: str = "value") -> DataFrame:
    """Parsed result lines; blank lines and lines that are no JSON object with a model are dropped."""
    kept = [c for c in raw.columns if c != value]
    present = spread(raw).filter(text.strip(F.col(value)) != "")
    parsed = present.select(*kept, text.evaluated_once(parse_run_line)(F.col(value)).alias("_line"))
    return parsed.select(*kept, "_line.*").filter("has_model_language")


def read_run_lines(spark: SparkSession, base: str, pattern: str = "*/{results.jsonl,part-*}") -> DataFrame:
    """Raw lines of all runs below ``base``: ``run_id, line_no, file_ts, value``.

    ``line_no`` orders the lines of a run: by file, by split of the file, by line in the split.
    It needs no count of the lines before it, so large files are read by many tasks.
    """
    scan = spark.read.option("recursiveFileLookup", True).text(f"{base}/{pattern}")
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1)
    return scan.select(
        F.regexp_replace(folder, "^run_id=", "").alias("run_id"),
        F.struct(
            F.col("_metadata.file_name").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
        ).alias("line_no"),
        F.unix_timestamp(F.col("_metadata.file_modification_time")).cast("double").alias("file_ts"),
        "value",
    )


def read_runs(spark: SparkSession, base: str, pattern: str = "*/{results.jsonl,part-*}") -> DataFrame:
    """Parsed lines of all runs below ``base``, one folder per run."""
    return run_lines(read_run_lines(spark, base, pattern))
