"""Queries of the training-data operators and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, merkle_manifest, ranked_search
from .byte_language import op13_byte_language
from .decontaminate import op7_decontaminate
from .hilbert_shards import op4_hilbert_shards
from .jaccard_join import op8_jaccard_join
from .license_scan import op1_license_scan
from .merkle_manifest import op12_merkle_manifest
from .mixing import op2_mixing
from .quality_rules import op10_quality_rules
from .ranked_search import op11_ranked_search
from .secret_scan import op3_secret_scan
from .separator_scan import op9_separator_scan
from .token_codes import op5_token_codes
from .toxicity import op6_toxicity


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_license_scan, op2_mixing, op3_secret_scan, op4_hilbert_shards, op5_token_codes, op6_toxicity,
        op7_decontaminate, op8_jaccard_join, op9_separator_scan, op10_quality_rules, op11_ranked_search,
        op12_merkle_manifest, op13_byte_language,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op7_decontaminate": decontaminate.ORACLE, "op11_ranked_search": ranked_search.ORACLE, "op12_merkle_manifest": merkle_manifest.ORACLE}
