"""Registered queries of the training-data operators, with DuckDB SQL where
SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (ann, decontamination, exact, licenses, mixing, secrets, sharding, simhash,
               suffixes, tokens, toxicity, warc, whitening)
from .common import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _on(table: str, fn):
    return lambda spark, sf_dir: fn(load(spark, sf_dir, table))


QUERIES["op6_ring_sharding"] = _on("documents", sharding.op6)
QUERIES["op7_mixing_tree"] = _on("documents", mixing.op7)
QUERIES["op4_covering_simhash"] = _on("documents", simhash.op4)
QUERIES["op10_toxic_segments"] = lambda spark, sf_dir: toxicity.op10(
    load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))
QUERIES["op9_cgk_decontamination"] = lambda spark, sf_dir: decontamination.op9(
    load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
QUERIES["op3_multi_index_hashing"] = _on("embeddings", ann.op3)
QUERIES["op2_credential_links"] = _on("documents", secrets.op2)
QUERIES["op5_license_inheritance"] = _on("documents", licenses.op5)
QUERIES["op8_warc_derivatives"] = _on("pages", warc.op8)
ORACLES["op8_warc_derivatives"] = warc.oracle_sql()
QUERIES["op1_cover_suffixes"] = _on("documents", suffixes.op1)
QUERIES["op13_heavy_hitter_dedup"] = _on("documents", exact.op13)
ORACLES["op13_heavy_hitter_dedup"] = exact.oracle_sql()
QUERIES["op12_token_alignment"] = _on("documents", tokens.op12)
QUERIES["op11_contour_whitening"] = _on("embeddings", whitening.op11)
