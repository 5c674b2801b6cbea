"""The queries of this subpackage over the given tables, with DuckDB SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from corvane.llm import (alignment, codec, collocations, decontaminate, gam, jaccard_join, line_dedup, perplexity, secrets,
                         sharding, snapshots, token_counts, toxicity)
from corvane.ship import ship

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def _register(name: str, sql: str | None = None):
    def keep(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            def read(table: str) -> DataFrame:
                return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")
            ship(spark)
            return fn(read)
        _QUERIES[name] = run
        if sql:
            _SQL[name] = sql
        return fn
    return keep


@_register("op1_decontamination")
def _op1(t):
    return decontaminate.leaks(t("documents"), t("benchmark"))


@_register("op2_sharding")
def _op2(t):
    out = sharding.shard_by_bytes(t("documents"))
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


@_register("op3_quality_classifier")
def _op3(t):
    return gam.score(t("documents"), t("labels"))


@_register("op4_secret_scan")
def _op4(t):
    return secrets.scan(t("documents"))


@_register("op5_token_counts")
def _op5(t):
    return token_counts.token_counts(t("documents"), public_tokenizers.path("byte_bpe_50k.json"))


@_register("op6_chat_snapshots", snapshots.SQL)
def _op6(t):
    return snapshots.maximal(t("conversations"))


@_register("op7_jaccard_join")
def _op7(t):
    return jaccard_join.components(t("documents")).select("doc_id", "n_shingles", "component_id")


@_register("op8_line_dedup")
def _op8(t):
    out = line_dedup.dedup(t("documents").select("doc_id", "text"), counts=True)
    return out.select("doc_id", "n_lines", "n_removed", "text")


@_register("op9_bpe_codec")
def _op9(t):
    return codec.encode(t("documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


@_register("op10_quality_rules")
def _op10(t):
    out = perplexity.quality(t("documents").select("doc_id", "lang", "text"))
    return out.select("doc_id", *perplexity.COUNTS, "base_failed", "kept", "log_perplexity")


@_register("op11_alignment")
def _op11(t):
    return alignment.alignment(t("documents"), public_tokenizers.path("byte_bpe_50k.json"),
                               public_tokenizers.path("piece_bpe_32k.model"))


@_register("op12_toxicity")
def _op12(t):
    return toxicity.score(t("documents"), t("labels"))


@_register("op13_collocations")
def _op13(t):
    return collocations.collocations(t("documents"))


_QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    _SQL["pipeline"] = corpus_pipeline.ORACLE_SQL


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
