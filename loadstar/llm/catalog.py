"""The registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loadstar.llm.chat import OP1_SQL, op1_chat_format
from loadstar.llm.decontamination import OP4_SQL, op4_decontamination
from loadstar.llm.fm_dedup import OP2_SQL, op2_fm_dedup
from loadstar.llm.hpylm import op12_language_model
from loadstar.llm.mixing import op8_mixing
from loadstar.llm.quality import OP7_SQL, op7_quality_rules
from loadstar.llm.simhash import op6_simhash
from loadstar.llm.suffix_dedup import op3_suffix_dedup
from loadstar.llm.tokens import op5_token_files
from loadstar.llm.toxicity import op10_toxicity
from loadstar.llm.trie import OP13_SQL, op13_trie
from loadstar.llm.warc import OP9_SQL, op9_warc
from loadstar.llm.whitening import op11_whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_format": op1_chat_format,
    "op2_fm_dedup": op2_fm_dedup,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_decontamination": op4_decontamination,
    "op5_token_files": op5_token_files,
    "op6_simhash": op6_simhash,
    "op7_quality_rules": op7_quality_rules,
    "op8_mixing": op8_mixing,
    "op9_warc": op9_warc,
    "op10_toxicity": op10_toxicity,
    "op11_whitening": op11_whitening,
    "op12_language_model": op12_language_model,
    "op13_trie": op13_trie,
}

ORACLE_SQL: dict[str, str] = {
    "op1_chat_format": OP1_SQL,
    "op2_fm_dedup": OP2_SQL,
    "op4_decontamination": OP4_SQL,
    "op7_quality_rules": OP7_SQL,
    "op9_warc": OP9_SQL,
    "op13_trie": OP13_SQL,
}
