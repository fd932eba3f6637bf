"""Registered queries with their SQL equivalents, over the driver's test tables.

Each module fills ``QUERIES`` (key to callable) and ``ORACLES`` (key to SQL text).
"""

from catalog import bronze, contracts, models, operations, relational, streams

MODULES = (relational, models, contracts, operations, bronze, streams)
QUERIES = {key: query for module in MODULES for key, query in module.QUERIES.items()}
ORACLES = {key: sql for module in MODULES for key, sql in module.ORACLES.items()}
