"""The two severity rules.

Reports rank the raw text case-sensitively; the detector normalises
(trim + upper case) before escalating. They are kept apart on purpose:
``high`` ranks 0 in a report but escalates to CRITICAL in the detector.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from alertscope.functions.text import _col, unicode_trim

# Report rank per severity text (anything else, null included → 0).
SEVERITY_RANKS = {"CRITICAL": 4, "HIGH": 3, "MEDIUM": 2, "LOW": 1}

# Escalation outcomes.
ESCALATE_TOP = ("CRITICAL", "HIGH")  # any of these seen → CRITICAL
ESCALATE_MID = "MEDIUM"  # else this seen → HIGH; else → MEDIUM


def severity_rank(c: Column | str) -> Column:
    """Case-sensitive rank of one severity value, as an int."""
    col = _col(c)
    expr = None
    for name, rank in SEVERITY_RANKS.items():
        expr = (F.when if expr is None else expr.when)(col == F.lit(name), F.lit(rank))
    return expr.otherwise(F.lit(0))


def normalised_severity(c: Column | str) -> Column:
    return F.upper(unicode_trim(_col(c)))


def escalated_severity(c: Column | str) -> Column:
    """Aggregate: the escalated severity of a group's severities.

    Algebraic (two ``bool_or`` flags), so it pre-aggregates map-side and
    keeps constant state in a stream, whatever the group size.
    """
    norm = normalised_severity(c)
    top = F.bool_or(F.coalesce(norm.isin(*ESCALATE_TOP), F.lit(False)))
    mid = F.bool_or(F.coalesce(norm == F.lit(ESCALATE_MID), F.lit(False)))
    return escalate_flags(top, mid)


def escalate_flags(top: Column, mid: Column) -> Column:
    """Escalated severity from the two flags (used after a partial merge)."""
    return (
        F.when(top, F.lit("CRITICAL"))
        .when(mid, F.lit("HIGH"))
        .otherwise(F.lit("MEDIUM"))
    )
