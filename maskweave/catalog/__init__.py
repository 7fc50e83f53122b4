"""Registry of queries (Spark) and their DuckDB oracle SQL."""

from __future__ import annotations

import importlib

_MODULES = ["sources_q", "text_q", "vocab_q", "encode_q", "curriculum_q", "batches_q", "stream_q", "unigram_q", "chains_q"]
FLAGSHIP = "flagship_batches"


def _prepared(fn):
    """Each registered query first makes sure the session has the shared
    checkpoint folder and this package on its Python workers."""
    def run(spark, sf_dir):
        from maskweave.session import prepare

        prepare(spark)
        return fn(spark, sf_dir)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def _collect():
    queries, oracles = {}, {}
    for m in _MODULES:
        mod = importlib.import_module(f"maskweave.catalog.{m}")
        queries.update({k: _prepared(v) for k, v in mod.QUERIES.items()})
        oracles.update(mod.ORACLES)
    return queries, oracles


def queries():
    return _collect()[0]


def oracles():
    return _collect()[1]
