"""Column expressions: every function here returns a JVM-side ``Column``."""

from ragloom.functions.text import (  # noqa: F401
    KEYWORD_PATTERN,
    basename_or_unknown,
    bround_stable,
    keyword_recall,
    lower_tokens,
    preview,
    round6,
    tokens,
)
from ragloom.functions.scoring import (  # noqa: F401
    GRADE_BANDS,
    WEIGHTS,
    grade,
    justification_codes,
    rqi,
)
