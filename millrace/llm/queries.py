"""All queries of this package, by name."""

import corpus_pipeline
from millrace.llm import native_queries, pair_queries, search_queries, text_queries  # noqa: F401
from millrace.llm.shared import QUERIES, query


@query(corpus_pipeline.ORACLE_SQL)
def pipeline(t):
    return corpus_pipeline.run(t.spark, t.folder)
