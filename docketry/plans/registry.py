"""Registered queries and their SQL oracles, by name."""

from __future__ import annotations

import inspect

from . import file_oracles, file_queries, oracles, packet_oracles, packet_queries, queries, stream_oracles, stream_queries

QUERIES = {
    name: fn
    for module in (queries, packet_queries, file_queries, stream_queries)
    for name, fn in vars(module).items()
    if inspect.isfunction(fn) and fn.__module__ == module.__name__ and not name.startswith("_")
}
ORACLES = oracles.ORACLES | packet_oracles.ORACLES | file_oracles.ORACLES | stream_oracles.ORACLES
