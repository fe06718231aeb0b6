"""Settings, read from the environment when they are asked for."""

from __future__ import annotations

import os
from dataclasses import dataclass, field


def _number(name: str, default: float) -> float:
    return float(os.environ.get(name, default))


def _choice(name: str, allowed: tuple[str, ...], default: str) -> str:
    value = os.environ.get(name, default).strip().lower()
    return value if value in allowed else default


@dataclass(frozen=True)
class Config:
    qualification_threshold: int = 3
    sales_qualification_threshold: int = 5
    enable_sales_scoring: bool = True
    scoring_max_concurrency: int = 3
    questions_in_flight: int = 4
    requests_per_second: float = 0.0
    comp_bounds: dict[str, tuple[float, float]] = field(default_factory=lambda: {"day": (50.0, 5000.0), "hour": (5.0, 500.0), "year": (10000.0, 2000000.0)})
    redact_mode: str = "flag"
    redact_on_failure: str = "drop"
    max_redact_rounds: int = 5
    min_confidence: float = 0.7
    transcript_char_cap: int = 120_000
    retry_attempts: int = 5
    retry_base_s: float = 1.0
    retry_max_s: float = 30.0
    cost_log_disabled: bool = False

    @classmethod
    def from_env(cls) -> Config:
        bands = {p: (_number(f"COMP_PLAUSIBLE_{p.upper()}_MIN", lo), _number(f"COMP_PLAUSIBLE_{p.upper()}_MAX", hi)) for p, (lo, hi) in cls().comp_bounds.items()}
        truthy = ("1", "true", "yes")
        return cls(
            qualification_threshold=int(_number("QUALIFICATION_THRESHOLD", 3)),
            sales_qualification_threshold=int(_number("SALES_QUALIFICATION_THRESHOLD", 5)),
            enable_sales_scoring=os.environ.get("ENABLE_SALES_SCORING", "true").lower() in truthy,
            scoring_max_concurrency=int(_number("SCORING_MAX_CONCURRENCY", 3)),
            questions_in_flight=int(_number("QUESTIONS_IN_FLIGHT", 4)),
            requests_per_second=_number("REQUESTS_PER_SECOND", 0.0),
            comp_bounds=bands,
            redact_mode=_choice("ARTICLE9_MODE", ("flag", "redact"), "flag"),
            redact_on_failure=_choice("ARTICLE9_REDACT_ON_FAILURE", ("drop", "fallback"), "drop"),
            max_redact_rounds=int(_number("ARTICLE9_MAX_REDACT_ROUNDS", 5)),
            min_confidence=_number("ARTICLE9_CONVERGENCE_MIN_CONFIDENCE", 0.7),
            transcript_char_cap=int(_number("TALENT_TRANSCRIPT_CHAR_CAP", 120_000)),
            retry_attempts=int(_number("LLM_RETRY_MAX_ATTEMPTS", 5)),
            retry_base_s=_number("LLM_RETRY_BASE_DELAY", 1.0),
            retry_max_s=_number("LLM_RETRY_MAX_DELAY", 30.0),
            cost_log_disabled=os.environ.get("SCORING_COST_LOG_DISABLED", "").lower() in truthy,
        )
