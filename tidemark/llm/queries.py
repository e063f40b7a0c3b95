"""Queries of the ten operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.decontaminate import OP4_SQL, op4_decontaminate
from tidemark.llm.html_text import op1_html_text
from tidemark.llm.jaccard_join import op7_jaccard_join
from tidemark.llm.mixture import OP8_SQL, op8_mixture
from tidemark.llm.quality_rules import op9_quality_rules
from tidemark.llm.quote_links import op10_quote_links
from tidemark.llm.substring_dedup import op3_substring_dedup
from tidemark.llm.token_files import op5_token_files
from tidemark.llm.topk_search import OP2_SQL, op2_topk_search
from tidemark.llm.url_filter import OP6_SQL, op6_url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op10_quote_links": op10_quote_links,
    "op1_html_text": op1_html_text,
    "op2_topk_search": op2_topk_search,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_decontaminate": op4_decontaminate,
    "op5_token_files": op5_token_files,
    "op6_url_filter": op6_url_filter,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_mixture": op8_mixture,
    "op9_quality_rules": op9_quality_rules,
}
ORACLES: dict[str, str] = {
    "op2_topk_search": OP2_SQL,
    "op4_decontaminate": OP4_SQL,
    "op6_url_filter": OP6_SQL,
    "op8_mixture": OP8_SQL,
}
