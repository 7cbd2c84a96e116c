"""Registered queries of the subpackage and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from netscope.llm import (byte_bpe, itq_neighbors, language_id, lattice_lm, line_dedup, minhash_links, packing,
                          phrase_index, quality_rules, recompression, site_quality, site_templates, whitening)

MODULES = (recompression, site_quality, packing, language_id, lattice_lm, quality_rules, site_templates, byte_bpe,
           itq_neighbors, minhash_links, phrase_index, whitening, line_dedup)
QUERIES = {m.NAME: m.query for m in MODULES}
ORACLES = {m.NAME: m.ORACLE for m in MODULES if getattr(m, "ORACLE", None)}
