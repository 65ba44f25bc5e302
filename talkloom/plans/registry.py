"""All queries of the core, by name, and their SQL."""

from __future__ import annotations

from talkloom.plans import frames, prediction, quality, reports, scripts, speech, text

MODULES = [quality, text, speech, prediction, frames, reports, scripts]

QUERIES = {k: v for m in MODULES for k, v in m.QUERIES.items()}
SQL = {k: v for m in MODULES for k, v in m.SQL.items()}
