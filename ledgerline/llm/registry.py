"""The queries of this subpackage and their DuckDB oracles."""

from __future__ import annotations

from . import (conversations, decontaminate, exact_dedup, language, licenses, merkle, near_dedup,
               pieces, quality, repeats, secrets, topk, url_filter)

_MODULES = [url_filter, repeats, secrets, pieces, decontaminate, near_dedup, licenses, language,
            exact_dedup, quality, conversations, merkle, topk]

QUERIES = {k: f for m in _MODULES for k, f in m.QUERIES.items()}
ORACLES = {k: s for m in _MODULES for k, s in m.ORACLES.items()}
