import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillsieve.operators import layout, position
from quillsieve.plans.jobs import filter_corpus, reshard_corpus
from quillsieve.plans.catalog import fixtures as fx
from quillsieve.sources.writers import write_shards

quick = settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@quick
@given(st.integers(1, 300), st.integers(1, 40))
def test_contiguous_shards_are_nearly_equal(spark, total, num_shards):
    rows = spark.range(total).select(layout.contiguous_shard(F.col("id"), total, num_shards).alias("s")).orderBy("s").collect()
    wanted = [s for s in range(num_shards) for _ in range(total // num_shards + (s < total % num_shards))]
    assert [r.s for r in rows] == wanted


@quick
@given(st.integers(1, 300), st.integers(1, 40))
def test_equal_shards_give_the_remainder_to_the_last(spark, total, num_shards):
    if num_shards > total:
        with pytest.raises(ValueError):
            layout.equal_shard(F.col("id"), total, num_shards)
        return
    rows = spark.range(total).select("id", layout.equal_shard(F.col("id"), total, num_shards).alias("s")).collect()
    assert all(r.s == min(r.id // (total // num_shards), num_shards - 1) for r in rows)


def test_index_over_files_and_order_within_shards(spark, tmp_path):
    """Many files, several write tasks per shard, more than ten shards: the order survives."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    numbered = spark.range(1000).withColumn("row_index", F.col("id"))
    write_shards(numbered, source, 1000, 3, rows_per_task=100)
    indexed = position.read_parquet_indexed(spark, source)
    assert len(indexed.inputFiles()) == 12
    assert indexed.filter("id <> row_index").count() == 0
    result = reshard_corpus(spark, source, out, 13).first()
    assert result.rows_before == result.rows_after == 1000
    assert result.rows_equal and result.content_equal
    sizes = {r.shard: r["count"] for r in spark.read.parquet(out).groupBy("shard").count().collect()}
    assert sizes == {**{s: 76 for s in range(12)}, 12: 88}
    assert position.read_parquet_indexed(spark, out).filter("id <> row_index").count() == 0


def test_parity_sees_a_changed_row(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.range(10).write.parquet(a)
    spark.range(1, 11).write.parquet(b)
    result = layout.parity(spark.read.parquet(a), spark.read.parquet(b)).first()
    assert result.rows_equal and not result.content_equal


def test_filter_corpus_keeps_the_order_and_names_the_threshold(spark, sf_dir, tmp_path):
    docs = fx.table(spark, sf_dir, "documents")
    docs.repartition(4).write.parquet(str(tmp_path / "web/cfg/train"))
    done = filter_corpus(spark, str(tmp_path / "web"), "cfg", "train", str(tmp_path / "kept"), fx.head(1), 0.5, num_shards=3)
    folder = done.folder
    assert folder.endswith("kept_threshold_0.5/data/cfg/train")
    assert done.rows_before == docs.count() and done.rows_after == spark.read.parquet(folder).count()
    source = position.read_parquet_indexed(spark, str(tmp_path / "web/cfg/train")).select("doc_id", F.col("row_index").alias("was"))
    kept = position.read_parquet_indexed(spark, folder).join(source, "doc_id").orderBy("row_index").collect()
    assert 0 < len(kept) < docs.count()
    assert [r.was for r in kept] == sorted(r.was for r in kept)
    assert all(r.score >= 0.5 for r in kept)


def test_ordered_index_with_a_hot_group_and_nulls(spark):
    rows = [("hot", i % 7, i) for i in range(600)] + [(None, 1, 1000 + i) for i in range(20)] + [("cold", 2, 2000)]
    df = spark.createDataFrame(rows, "g string, v int, i int").repartition(5)
    got = {(r.g, r.row_index): (r.v, r.i) for r in position.with_ordered_index(df, [F.desc("v"), "i"], by=["g"]).collect()}
    assert len(got) == len(rows)
    for group in ("hot", None, "cold"):
        wanted = sorted(((v, i) for g, v, i in rows if g == group), key=lambda x: (-x[0], x[1]))
        assert [got[group, k] for k in range(len(wanted))] == wanted


def test_running_total(spark):
    values = np.random.default_rng(0).integers(0, 9, 500).tolist()
    df = spark.createDataFrame(list(enumerate(values)), "i int, w long").repartition(6)
    rows = position.running_total(df, ["i"], "w", "t").orderBy("i").collect()
    assert [r.t for r in rows] == np.cumsum(values).tolist()


@pytest.mark.parametrize("n", [-1, 0, 3, 20_000, 50_000])
def test_take_rows(spark, n):
    got = position.take_rows(spark.range(40_000).repartition(4), n, ["id"], descending=True).agg(F.count("*"), F.min("id")).first()
    assert got[0] == min(max(n, 0), 40_000)
    assert n <= 0 or got[1] == max(40_000 - n, 0)


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("n", [1, 2, 5, 7, 8])
def test_take_rows_with_ties_and_nulls(spark, n, descending):
    """Nulls come first, last when descending; ties across the border are an error."""
    values = [None, None, 1, 1, 1, 2, 2]
    df = spark.createDataFrame([(v, "x" * i) for i, v in enumerate(values)], "v int, t string")
    got = position.take_rows(df, n, ["v", "t"], descending).collect()
    order = sorted(range(7), key=lambda i: (values[i] or 0, i), reverse=descending)
    assert {len(r.t) for r in got} == set(order[:n])
    if n in (2, 5, 7, 8) and not descending:
        assert position.take_rows(df, n, ["v"]).count() == min(n, 7)
    elif not descending:
        with pytest.raises(ValueError):
            position.take_rows(df, n, ["v"])


@pytest.mark.parametrize("bounded", [True, False])
def test_average_ranks_either_way(spark, bounded):
    """The one-window way and the sort by range agree with ranks by hand."""
    values = {"a": [3.0, 1.0, 3.0, 2.0, 3.0], "b": [5.0, 5.0, 4.0]}
    df = spark.createDataFrame([(g, v) for g, vs in values.items() for v in vs], "g string, v double")
    histogram = df.groupBy("g", "v").agg(F.count("*").alias("n"))
    got = {(r.g, r.v): r.rank for r in position.average_ranks(histogram, "v", "n", "rank", by=["g"], bounded=bounded).collect()}
    assert got == {("a", 1.0): 1.0, ("a", 2.0): 2.0, ("a", 3.0): 4.0, ("b", 4.0): 1.0, ("b", 5.0): 2.5}


def test_parity_of_maps(spark):
    rows = spark.sql("SELECT id, map('a', id, 'b', 1) AS m, array(struct(map('k', id) AS inner)) AS deep FROM range(20)")
    turned = spark.sql("SELECT id, map('b', 1, 'a', id) AS m, array(struct(map('k', id) AS inner)) AS deep FROM range(20)")
    assert layout.parity(rows, turned).first().content_equal
    assert not layout.parity(rows, rows.withColumn("m", F.create_map(F.lit("a"), F.col("id")))).first().content_equal


def test_validation_rows_prefer_the_named_splits(spark):
    df = spark.createDataFrame([("train", i) for i in range(10)] + [("test", 10), ("val", 11)], "split string, row_index long")
    names = lambda d: sorted((r.split, r.row_index) for r in layout.validation_rows(d).collect())
    assert names(df) == [("val", 11)]
    assert names(df.filter("split <> 'val'")) == [("test", 10)]
    assert names(df.filter("split = 'train'")) == [("train", 0), ("train", 1)]
