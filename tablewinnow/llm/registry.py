"""The queries of this package, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tablewinnow.llm import (
    alignment,
    fingerprints,
    language,
    mixing,
    near_dedup,
    packing,
    periodic,
    pii,
    quality,
    secrets,
    toxicity,
    urls,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_mix_sources": mixing.op1_mix_sources,
        "op2_pack": packing.op2_pack,
        "op3_simhash": fingerprints.op3_simhash,
        "op4_quality": quality.op4_quality,
        "op5_toxicity": toxicity.op5_toxicity,
        "op6_near_dedup": near_dedup.op6_near_dedup,
        "op7_language": language.op7_language,
        "op8_pii": pii.op8_pii,
        "op9_url_verdicts": urls.op9_url_verdicts,
        "op10_secrets": secrets.op10_secrets,
        "op11_align_tokens": alignment.op11_align_tokens,
        "op12_periodic_runs": periodic.op12_periodic_runs,
        "op13_warc": warc.op13_warc,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_mix_sources": mixing.ORACLE,
        "op9_url_verdicts": urls.oracle(),
        "op13_warc": warc.ORACLE,
    }
