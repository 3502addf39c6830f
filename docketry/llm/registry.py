"""Names of this subpackage's queries, and the SQL of those that SQL can express."""

from __future__ import annotations

from . import oracles, queries

QUERIES = {name: fn for name, fn in vars(queries).items() if name.startswith("op")}
ORACLES = dict(oracles.ORACLES)
