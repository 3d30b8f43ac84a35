"""Every registered query, with the SQL that must give the same rows."""

from tierlake.queries import bronze, gold, quality, silver

MODULES = (gold, silver, bronze, quality)

QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: text for module in MODULES for name, text in module.ORACLES.items()}
