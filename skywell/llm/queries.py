"""The named queries of this package and the pipeline, and their SQL."""

import corpus_pipeline
from skywell.llm import bestfit, decontaminate, extract, langid, linkrank, neardup, neighbours, packing, periodic, phrases, ppm, quality, secrets  # noqa: F401
from skywell.llm.common import QUERIES, SQL

QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
