"""The subpackage's registered queries, one per operator, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from devsignals.llm import (decontamination, fixity, hard_negatives, language_id, licenses, line_rules, manifest,
                            pitman_yor, quality_crf, sentence_pieces, simhash, site_lines, toxicity)
from devsignals.llm.common import table


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_line_dedup": lambda s, d: site_lines.query(table(s, d, "documents")),
        "op2_quality_crf": lambda s, d: quality_crf.query(table(s, d, "documents"), table(s, d, "labels")),
        "op3_sentencepiece": lambda s, d: sentence_pieces.query(table(s, d, "documents"), piece_model()),
        "op4_language_id": lambda s, d: language_id.query(table(s, d, "documents")),
        "op5_line_frequency_rules": lambda s, d: line_rules.query(table(s, d, "documents")),
        "op6_warc_fixity": lambda s, d: fixity.query(table(s, d, "pages")),
        "op7_simhash": lambda s, d: simhash.query(table(s, d, "documents")),
        "op8_decontamination": lambda s, d: decontamination.query(table(s, d, "documents"), table(s, d, "benchmark")),
        "op9_pitman_yor": lambda s, d: pitman_yor.query(table(s, d, "documents")),
        "op10_license_scan": lambda s, d: licenses.query(table(s, d, "documents")),
        "op11_toxicity": lambda s, d: toxicity.query(table(s, d, "documents"), table(s, d, "labels")),
        "op12_merkle_manifest": lambda s, d: manifest.query(table(s, d, "documents")),
        "op13_hard_negatives": lambda s, d: hard_negatives.query(table(s, d, "embeddings")),
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": site_lines.SQL, "op6_warc_fixity": fixity.SQL, "op10_license_scan": licenses.sql(),
            "op12_merkle_manifest": manifest.SQL, "op13_hard_negatives": hard_negatives.SQL}
