"""Queries of the corpus operators and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bpe import op2_bpe
from .decontamination import OP9_SQL, op9_decontamination
from .fingerprints import op1_fingerprints
from .hard_negatives import OP12_SQL, op12_hard_negatives
from .language import op10_language
from .licenses import OP6_SQL, op6_licenses
from .lines import OP8_SQL, op8_lines
from .pages import op7_pages
from .passages import op5_passages
from .quality_rules import OP13_SQL, op13_quality_rules
from .secrets import op4_secrets
from .simhash import op3_simhash
from .whitening import op11_whitening

Query = Callable[[SparkSession, str], DataFrame]


def llm_queries() -> dict[str, Query]:
    return {
        "op1_fingerprints": op1_fingerprints,
        "op2_bpe": op2_bpe,
        "op3_simhash": op3_simhash,
        "op4_secrets": op4_secrets,
        "op5_passages": op5_passages,
        "op6_licenses": op6_licenses,
        "op7_pages": op7_pages,
        "op8_lines": op8_lines,
        "op9_decontamination": op9_decontamination,
        "op10_language": op10_language,
        "op11_whitening": op11_whitening,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_quality_rules": op13_quality_rules,
    }


def llm_oracles() -> dict[str, str]:
    return {
        "op6_licenses": OP6_SQL, "op8_lines": OP8_SQL, "op9_decontamination": OP9_SQL,
        "op12_hard_negatives": OP12_SQL, "op13_quality_rules": OP13_SQL,
    }
