"""All queries of the optional part: the operators and the pipeline over them."""

import corpus_pipeline

from . import queries

QUERIES = {**queries.QUERIES, "pipeline": corpus_pipeline.run}
ORACLES = queries.ORACLES | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
