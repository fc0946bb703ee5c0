"""Named queries over the tables of a data directory, and SQL that gives the same rows."""

from corpuskit.plans import corpus, dialogue, files, retrieval, web

PARTS = (corpus, retrieval, dialogue, web, files)
QUERIES = {name: query for part in PARTS for name, query in part.QUERIES.items()}
ORACLES = {name: sql for part in PARTS for name, sql in part.ORACLES.items()}
