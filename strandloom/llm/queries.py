"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .ann import op8_ann_adaptive_scan
from .decontaminate import op9_decontaminate
from .line_dedup import OP7_SQL, op7_line_dedup
from .lm_score import op3_lm_score
from .ngram_join import OP1_SQL, op1_ngram_jaccard_join
from .quality import op6_quality
from .sentencepiece import op10_sentencepiece
from .substring_dedup import op5_substring_dedup
from .toxicity import op2_toxicity
from .warc import OP4_SQL, op4_warc_revisits

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard_join,
        op2_toxicity,
        op3_lm_score,
        op4_warc_revisits,
        op5_substring_dedup,
        op6_quality,
        op7_line_dedup,
        op8_ann_adaptive_scan,
        op9_decontaminate,
        op10_sentencepiece,
    )
}

ORACLES: dict[str, str] = {"op1_ngram_jaccard_join": OP1_SQL, "op4_warc_revisits": OP4_SQL, "op7_line_dedup": OP7_SQL}
