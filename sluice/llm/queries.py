"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sluice.llm.bagminhash import op7_bagminhash
from sluice.llm.hard_negatives import op13_hard_negatives
from sluice.llm.license_scan import op2_license_scan
from sluice.llm.mixing import op6_mixing
from sluice.llm.oracles import oracle_sql  # noqa: F401
from sluice.llm.quality_classifier import op5_quality_classifier
from sluice.llm.quality_rules import op1_quality_rules
from sluice.llm.secret_scan import op4_secret_scan
from sluice.llm.sentencepiece_codec import op8_sentencepiece
from sluice.llm.token_records import op10_token_records
from sluice.llm.topk import op3_topk
from sluice.llm.vector_dedup import op12_vector_dedup
from sluice.llm.warc import op9_warc
from sluice.llm.whitening import op11_whitening


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_rules": op1_quality_rules,
        "op2_license_scan": op2_license_scan,
        "op3_topk": op3_topk,
        "op4_secret_scan": op4_secret_scan,
        "op5_quality_classifier": op5_quality_classifier,
        "op6_mixing": op6_mixing,
        "op7_bagminhash": op7_bagminhash,
        "op8_sentencepiece": op8_sentencepiece,
        "op9_warc": op9_warc,
        "op10_token_records": op10_token_records,
        "op11_whitening": op11_whitening,
        "op12_vector_dedup": op12_vector_dedup,
        "op13_hard_negatives": op13_hard_negatives,
    }
