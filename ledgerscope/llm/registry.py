"""Queries of this subpackage and their DuckDB SQL (only where SQL can express them)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerscope.llm.conversation_trie import op13_conversation_trie
from ledgerscope.llm.embedding_dedup import op1_embedding_itq
from ledgerscope.llm.language_id import op2_language_id
from ledgerscope.llm.mixing import OP8_SQL, op8_source_mixing
from ledgerscope.llm.packing import op7_best_fit_packing
from ledgerscope.llm.page_diff import op3_page_differencing
from ledgerscope.llm.pii import op4_pii
from ledgerscope.llm.quality_classifier import op10_quality_mil
from ledgerscope.llm.quality_rules import op5_quality_rules
from ledgerscope.llm.sentence_pieces import op11_sentence_pieces
from ledgerscope.llm.simhash import op6_simhash
from ledgerscope.llm.spelling import op12_spelling_variants
from ledgerscope.llm.token_files import op9_token_files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embedding_itq": op1_embedding_itq,
    "op2_language_id": op2_language_id,
    "op3_page_differencing": op3_page_differencing,
    "op4_pii": op4_pii,
    "op5_quality_rules": op5_quality_rules,
    "op6_simhash": op6_simhash,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_source_mixing": op8_source_mixing,
    "op9_token_files": op9_token_files,
    "op10_quality_mil": op10_quality_mil,
    "op11_sentence_pieces": op11_sentence_pieces,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_conversation_trie": op13_conversation_trie,
}

ORACLE: dict[str, str] = {"op8_source_mixing": OP8_SQL}
