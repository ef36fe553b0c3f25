"""Corpus quality annotation on Spark: score, filter, label, distil, re-shard, explore."""

__version__ = "0.1.0"
