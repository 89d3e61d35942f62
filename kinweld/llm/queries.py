"""The queries of this subpackage and the SQL that some of them equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kinweld.llm.bpe import op4_bpe
from kinweld.llm.exact_dedup import OP3_SQL, op3_exact_dedup
from kinweld.llm.jaccard_join import op9_jaccard_join
from kinweld.llm.language_id import op2_language_id
from kinweld.llm.lexical_search import OP11_SQL, op11_lexical_search
from kinweld.llm.line_dedup import OP12_SQL, op12_line_dedup
from kinweld.llm.mixing import OP10_SQL, op10_mixing
from kinweld.llm.quality_fm import op8_quality_fm
from kinweld.llm.quality_rules import op7_quality_rules
from kinweld.llm.spelling import OP13_SQL, op13_spelling
from kinweld.llm.substring_dedup import op5_substring_dedup
from kinweld.llm.token_counts import op6_token_counts
from kinweld.llm.toxicity import op1_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_language_id": op2_language_id,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_bpe": op4_bpe,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_token_counts": op6_token_counts,
    "op7_quality_rules": op7_quality_rules,
    "op8_quality_fm": op8_quality_fm,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_mixing": op10_mixing,
    "op11_lexical_search": op11_lexical_search,
    "op12_line_dedup": op12_line_dedup,
    "op13_spelling": op13_spelling,
}

ORACLE_SQL: dict[str, str] = {"op3_exact_dedup": OP3_SQL, "op10_mixing": OP10_SQL, "op11_lexical_search": OP11_SQL, "op12_line_dedup": OP12_SQL, "op13_spelling": OP13_SQL}
