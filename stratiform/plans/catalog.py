"""All registered queries: name -> (spark callable, DuckDB oracle SQL or None)."""

from __future__ import annotations

from . import (queries_eval, queries_folds, queries_models, queries_neighbours, queries_prep, queries_stats,
               queries_training)

MODULES = [queries_prep, queries_stats, queries_eval, queries_neighbours, queries_models,
           queries_training, queries_folds]


def catalog() -> dict:
    out = {}
    for m in MODULES:
        out.update(m.QUERIES)
    return out
