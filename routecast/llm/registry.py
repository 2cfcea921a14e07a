"""Queries and DuckDB twins of this subpackage."""

from __future__ import annotations

from routecast.llm import (
    bpe,
    cap_filters,
    fill_middle,
    html_text,
    language,
    line_dedup,
    minhash,
    multi_index,
    packing,
    quality,
    spelling,
    suffix_tree,
    url_filter,
)


def _pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


_MODULES = (
    bpe,
    cap_filters,
    fill_middle,
    html_text,
    language,
    line_dedup,
    minhash,
    multi_index,
    packing,
    quality,
    spelling,
    suffix_tree,
    url_filter,
)

QUERIES = {name: fn for m in _MODULES for name, fn in m.QUERIES.items()}
QUERIES["pipeline"] = _pipeline
ORACLES = {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
