"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from reviewmart.llm import (
    bpe,
    langid,
    lattice,
    licences,
    minhash,
    multiindex,
    ngrams,
    packing,
    prefixes,
    quality,
    runs,
    toolcalls,
    toxicity,
)

_MODULES = (ngrams, packing, multiindex, lattice, bpe, langid, toxicity, licences, minhash, toolcalls, quality, prefixes, runs)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
