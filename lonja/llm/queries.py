"""The registered queries of the document operators and, where SQL can express one, its counterpart."""

from __future__ import annotations

import re

from lonja.llm import (
    decontaminate,
    hosts,
    html_template,
    katz,
    language,
    lines,
    near_dedup,
    order_minhash,
    packing,
    periodic_runs,
    quality,
    sharding,
    spelling,
)

_MODULES = (quality, packing, near_dedup, katz, order_minhash, language, hosts, sharding, decontaminate, lines, spelling, html_template, periodic_runs)


def queries():
    return {name: query for module in _MODULES for name, query in vars(module).items() if re.match(r"op\d+_", name)}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in getattr(module, "ORACLE_SQL", {}).items()}
