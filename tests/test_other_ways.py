"""The plans for data beyond the size bounds, forced on small tables: results must not change."""

import pytest

from quillsieve import sizing
from tests.compare import difference, duck

NAMES = [
    "cap_per_run", "cluster_rows", "color_legend", "head_leaderboard", "ordered_index", "page_by_score", "reshard_files", "resume_anti_join",
    "run_summary", "spearman", "spearman_continuous", "take_n", "validate_head", "validate_head_batched",
]


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", NAMES)
def test_without_small_sides(spark, sf_dir, connection, monkeypatch, name):
    monkeypatch.setattr(sizing, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(sizing, "SPREAD_BYTES", 0)
    monkeypatch.setattr(sizing, "SPLIT_BYTES", 10_000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        problem, count, _ = difference(spark, name, sf_dir, connection)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert problem is None and count > 0
