"""Column-level building blocks (built-in Spark expressions only)."""
from cargoline.functions.columns import (  # noqa: F401
    EXCEPTION_COVER_DAYS,
    RISK_WEIGHTS,
    SEVERITY_BANDS,
    TIER_PENALTY,
    as_double,
    cents_to_money,
    clip,
    flag_int,
    flag_rate,
    holds,
    is_finite,
    isclose,
    money,
    non_negative,
    ratio,
    safe_ratio,
    severity,
    severity_rank,
    tier_penalty,
)
