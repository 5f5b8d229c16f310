"""All queries of this subpackage, the pipeline among them."""

from __future__ import annotations

import corpus_pipeline
from ledgerline.llm import data_queries, shape_queries, text_queries  # noqa: F401  (they register themselves)
from ledgerline.llm.registry import QUERIES, SQL

QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
