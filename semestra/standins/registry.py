"""All registered queries with their reference SQL."""

from semestra.standins import ingest, loads, olap, quality

_MODULES = [olap, ingest, quality, loads]
QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
