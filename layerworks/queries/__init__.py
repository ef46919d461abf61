"""Every operator as a query over the test tables, with the same result in plain SQL."""

from layerworks.queries import access, analytics, documents, feeds, files

_MODULES = (analytics, feeds, documents, files, access)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
