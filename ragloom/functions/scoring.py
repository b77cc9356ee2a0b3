"""Composite quality index, letter grade and rule codes (Q1-Q3)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference for equal results:
# index weights retrieval 0.4, generation 0.3, judged 0.3;
# grade bands on the unrounded index: >=0.9 A+, >=0.8 A, >=0.7 B, >=0.6 C,
# >=0.5 D, else F.
WEIGHTS = {"retrieval": 0.4, "generation": 0.3, "ragas": 0.3}
GRADE_BANDS = [(0.9, "A+"), (0.8, "A"), (0.7, "B"), (0.6, "C"), (0.5, "D")]

# Rule codes for the justification (the wording is ours).  Thresholds are the
# reference's: retrieval < 0.6; generation < 0.6 / > 0.8; judged < 0.6 /
# > 0.8; paradox when retrieval > 0.8 and judged < 0.5.
RULE_CODES = {
    "retrieval_low": "RETRIEVAL_BOTTLENECK",
    "retrieval_ok": "RETRIEVAL_HEALTHY",
    "generation_low": "GENERATION_LOW",
    "generation_high": "GENERATION_HIGH",
    "judged_low": "JUDGED_POOR",
    "judged_high": "JUDGED_STRONG",
    "paradox": "RAG_PARADOX",
}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def rqi(retrieval="retrieval", generation="generation", judged="ragas",
        weights: dict | None = None) -> Column:
    """Weighted index, evaluated left to right as r*w_r + g*w_g + j*w_j."""
    w = weights or WEIGHTS
    return (_c(retrieval) * F.lit(w["retrieval"])
            + _c(generation) * F.lit(w["generation"])
            + _c(judged) * F.lit(w["ragas"]))


def grade(index="rqi") -> Column:
    """Letter grade of the unrounded index; null index gives null grade."""
    x = _c(index)
    expr = None
    for bound, letter in GRADE_BANDS:
        cond = x >= F.lit(bound)
        expr = F.when(cond, letter) if expr is None else expr.when(cond, letter)
    return F.when(x.isNull(), F.lit(None).cast("string")).otherwise(expr.otherwise("F"))


def justification_codes(retrieval="retrieval", generation="generation",
                        judged="ragas", sep: str = "\n") -> Column:
    """Rule codes in the reference's order, joined by ``sep``.

    Generation and judged scores in [0.6, 0.8] add nothing.
    """
    r, g, j = _c(retrieval), _c(generation), _c(judged)
    rc = RULE_CODES
    return F.concat_ws(
        sep,
        F.when(r < 0.6, F.lit(rc["retrieval_low"])).otherwise(F.lit(rc["retrieval_ok"])),
        F.when(g < 0.6, F.lit(rc["generation_low"])).when(g > 0.8, F.lit(rc["generation_high"])),
        F.when(j < 0.6, F.lit(rc["judged_low"])).when(j > 0.8, F.lit(rc["judged_high"])),
        F.when((r > 0.8) & (j < 0.5), F.lit(rc["paradox"])),
    )
