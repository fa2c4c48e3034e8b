"""Queries of the operators that read texts and pages in Python on Arrow batches."""

from __future__ import annotations

from pyspark.sql import DataFrame

from millrace.llm.packing import pack_documents
from millrace.llm.page_text import extract_pages
from millrace.llm.quality_net import quality_scores
from millrace.llm.secret_forest import find_secrets
from millrace.llm.sentence_spans import drop_repeated
from millrace.llm.shared import query
from millrace.llm.token_ids import tokenizer_file


@query()
def op1_html_extraction(t) -> DataFrame:
    return extract_pages(t.pages)


@query()
def op2_best_fit_packing(t) -> DataFrame:
    return pack_documents(t.documents, tokenizer_file())


@query()
def op3_substring_dedup(t) -> DataFrame:
    return drop_repeated(t.documents)


@query()
def op4_quality_classifier(t) -> DataFrame:
    return quality_scores(t.documents, t.labels)


@query()
def op9_secret_scan(t) -> DataFrame:
    return find_secrets(t.documents)
