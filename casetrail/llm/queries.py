"""Registered queries of the training-data operators and their DuckDB SQL."""
from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from . import sql
from .common import table

#: Where the vocabulary files are; the library's own folder by default.
TOKENIZERS = os.environ.get("CASETRAIL_TOKENIZERS")
_REPO = str(Path(__file__).resolve().parents[2])


def vocabulary(name: str) -> str:
    if TOKENIZERS:
        return f"{TOKENIZERS}/{name}"
    import public_tokenizers
    return public_tokenizers.path(name)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    # workers of a local session started elsewhere find this package, too
    spark.sparkContext.environment.setdefault("PYTHONPATH", _REPO)
    return table(spark, sf_dir, "documents")


def op1_bit_planes(spark, sf_dir):
    from .token_planes import plane_files
    return plane_files(_documents(spark, sf_dir), vocabulary("word_bpe_49k.json"))


def op2_token_counts(spark, sf_dir):
    from .token_counts import token_counts
    return token_counts(_documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"))


def op3_mixing(spark, sf_dir):
    from .mixing import mix
    return mix(_documents(spark, sf_dir)).drop("copies")


def op4_host_rules(spark, sf_dir):
    from .host_rules import host_verdicts
    return host_verdicts(_documents(spark, sf_dir)).drop("host_rate")


def op5_pii(spark, sf_dir):
    from .pii import personal_data
    return personal_data(_documents(spark, sf_dir))


def op6_ngram_join(spark, sf_dir):
    from .ngram_join import near_copies
    return near_copies(_documents(spark, sf_dir)).drop("class_id")


def op7_suffix_dedup(spark, sf_dir):
    from .suffix_dedup import repeated_bytes
    return repeated_bytes(_documents(spark, sf_dir))


def op8_exact_dedup(spark, sf_dir):
    from .exact_dedup import exact_dedup
    return exact_dedup(_documents(spark, sf_dir))


def op9_toxicity(spark, sf_dir):
    from .toxicity import toxicity_scores
    return toxicity_scores(_documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op10_pieces(spark, sf_dir):
    from .pieces import encode_pieces
    return encode_pieces(_documents(spark, sf_dir), vocabulary("piece_bpe_32k.model"), with_ids=True)


def op11_merkle_manifest(spark, sf_dir):
    from .merkle import merkle_manifest
    return merkle_manifest(_documents(spark, sf_dir))


def op12_merge_replay(spark, sf_dir):
    from .merge_replay import replay_tokens
    import public_tokenizers
    return replay_tokens(_documents(spark, sf_dir), vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op13_token_alignment(spark, sf_dir):
    from .token_alignment import align_tokens
    return align_tokens(_documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


def pipeline(spark, sf_dir):
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


_QUERIES = [op1_bit_planes, op2_token_counts, op3_mixing, op4_host_rules, op5_pii, op6_ngram_join, op7_suffix_dedup,
            op8_exact_dedup, op9_toxicity, op10_pieces, op11_merkle_manifest, op12_merge_replay, op13_token_alignment, pipeline]


def registry() -> dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]]:
    return {f.__name__: (f, sql.ORACLE.get(f.__name__)) for f in _QUERIES}
