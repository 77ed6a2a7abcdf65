"""All queries of this folder: name -> (query, SQL or None)."""

from __future__ import annotations

from roadpulse.llm import (
    bpe,
    collocations,
    exact_dedup,
    language_id,
    lattice_lm,
    license_scan,
    near_dedup,
    packing,
    pii,
    suffix_dedup,
    toxicity,
    vp_search,
    whitening,
)

MODULES = (license_scan, toxicity, packing, vp_search, suffix_dedup, near_dedup, language_id, bpe, exact_dedup, lattice_lm, pii, whitening, collocations)


def llm_queries():
    return {name: fn for m in MODULES for name, (fn, _) in m.QUERIES.items()}


def llm_oracles():
    return {name: sql for m in MODULES for name, (_, sql) in m.QUERIES.items() if sql is not None}
