"""The registered queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from quayside.llm import dictionary_codes, disclosure, gated_lm, langid, mixing, neighbours, pieces, prefix_trie, rules, simhash, toxicity, unlabelled, warc

_MODULES = (langid, pieces, simhash, warc, neighbours, gated_lm, disclosure, mixing, rules, toxicity,
            prefix_trie, dictionary_codes, unlabelled)
QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}
