"""The queries of this subpackage, by name."""

from __future__ import annotations

from .decontaminate import OP2_SQL, op2_decontamination
from .fill_middle import OP11_SQL, op11_fill_middle
from .html_extract import op8_html_extract
from .language_model import op9_lm_score
from .merkle import OP13_SQL, op13_merkle_manifest
from .near_dedup import OP3_SQL, op3_near_dedup
from .parity_join import OP12_SQL, op12_ngram_join
from .pieces import op6_sentencepiece
from .quality import op1_quality_rules
from .quality_classifier import op4_quality_classifier
from .repeats import OP7_SQL, op7_substring_dedup
from .toxicity import op10_toxicity
from .url_filter import OP5_SQL, op5_url_filter

QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_decontamination": op2_decontamination,
    "op3_near_dedup": op3_near_dedup,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_url_filter": op5_url_filter,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_html_extract": op8_html_extract,
    "op9_lm_score": op9_lm_score,
    "op10_toxicity": op10_toxicity,
    "op11_fill_middle": op11_fill_middle,
    "op12_ngram_join": op12_ngram_join,
    "op13_merkle_manifest": op13_merkle_manifest,
}
ORACLES: dict[str, str] = {
    "op2_decontamination": OP2_SQL,
    "op3_near_dedup": OP3_SQL,
    "op5_url_filter": OP5_SQL,
    "op7_substring_dedup": OP7_SQL,
    "op11_fill_middle": OP11_SQL,
    "op12_ngram_join": OP12_SQL,
    "op13_merkle_manifest": OP13_SQL,
}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
