"""Training-data operators: formatting, deduplication, filtering, tokenisation.

Nothing outside this subpackage imports it; ``queries`` holds the thin
``opN_<name>`` queries that the entry module registers.
"""
