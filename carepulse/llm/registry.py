"""All queries and SQL of this subpackage, and the pipeline, for the entry point."""

import corpus_pipeline

from carepulse.llm import queries  # noqa: F401
from carepulse.llm.common import ORACLES, QUERIES

QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
