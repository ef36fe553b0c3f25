"""The command line, job after job on one folder."""

import json

import pytest

from quillsieve.__main__ import parser, run
from quillsieve.operators.heads import save_heads
from quillsieve.plans.catalog import fixtures as fx
from quillsieve.sources.responders import chat_server


def word_scorer():
    """A responder that scores by the number of words."""
    return lambda requests: [json.dumps({"score": len(m[-1]["content"].split()) % 5, "reasoning": "r", "keywords": ["k"]}) for m in requests]


def test_jobs(spark, sf_dir, tmp_path, capsys):
    call = lambda *argv: run(spark, parser().parse_args([str(a) for a in argv]))
    docs = fx.documents(spark, sf_dir).selectExpr("cast(id as string) id", "url", "text", "lang")
    web, heads, runs, kept = tmp_path / "web/cfg/train", tmp_path / "heads", tmp_path / "runs", tmp_path / "kept"
    docs.write.parquet(str(web))
    save_heads(spark, str(heads), fx.head(1))
    call("annotate", web, tmp_path / "data", "--stats-folder", tmp_path / "stats", "--encoder", "hashing-64", "--heads", heads)
    assert "score_b" in spark.read.json(str(tmp_path / "stats")).columns
    call("filter", tmp_path / "web", "cfg", "train", kept, "--heads", heads, "--head", "b", "--threshold", 0.5, "--num-shards", 2)
    filtered = f"{kept}_threshold_0.5/data/cfg/train"
    assert filtered in capsys.readouterr().out
    call("reshard", filtered, tmp_path / "equal", "--num-shards", 3)
    assert "true" in capsys.readouterr().out
    call("label", "score", web, runs, "--responder", "tests.test_cli:word_scorer", "--model", "m", "--num-examples", 150)
    assert spark.read.json(str(runs)).count() == 150
    call("label", "synthesize", web, tmp_path / "blog", "--responder", "tests.test_cli:word_scorer", "--num-examples", 5)
    assert spark.read.json(str(tmp_path / "blog")).filter("source_file like 'part-%'").count() == 5
    call("explore", runs)
    assert "m-arb_Arab-" in capsys.readouterr().out
    call("distil", runs, tmp_path / "heads2", "--distilled-model-name", "m", "--base-model-name", "hashing-8", "--train-batch-size", 64)
    assert "spearman" in capsys.readouterr().out


def test_server_client_is_optional():
    try:
        import openai  # noqa: F401
    except ImportError:
        with pytest.raises(ImportError, match="openai"):
            chat_server("http://localhost:1/v1", "m")()
