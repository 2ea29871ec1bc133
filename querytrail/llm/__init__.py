"""Training-data operators: formatting, scoring, dedup, packing, PII, search.

Nothing outside this subpackage imports it.  Each operator module has a
general function over DataFrames; the thin driver queries are in
:mod:`querytrail.llm.queries` and their DuckDB SQL in
:mod:`querytrail.llm.oracles`.
"""
