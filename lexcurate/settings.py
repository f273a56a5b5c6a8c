"""Settings of a run: defaults, then the environment, then what the caller gives; all within bounds."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields, replace

from lexcurate.functions.lexicons import Lexicon
from lexcurate.operators.scoring import Retry

# fixed values: the least and largest value of each setting
BOUNDS = {
    "target_samples": (1, None), "batch_size": (1, 10_000), "max_retries": (1, 20), "retry_base_delay": (0.1, 30.0), "min_text_length": (10, None),
    "max_text_length": (1000, None), "inference_truncation_chars": (500, 20_000), "max_concurrent_requests": (1, 50),
}


@dataclass(frozen=True)
class Settings:
    """``max_concurrent_requests`` is the number of tasks that call a scorer at a time."""

    output_dir: str = "./data"
    target_samples: int = 100_000
    batch_size: int = 1000
    max_retries: int = 5
    retry_base_delay: float = 1.0
    min_text_length: int = 1000
    max_text_length: int = 50_000
    inference_truncation_chars: int = 3000
    keyword_filter_enabled: bool = True
    max_concurrent_requests: int = 5

    def __post_init__(self) -> None:
        for name, (least, most) in BOUNDS.items():
            value = getattr(self, name)
            if value < least or (most is not None and value > most):
                raise ValueError(f"{name} must lie between {least} and {most}, not {value}")

    @property
    def batches_dir(self) -> str:
        return f"{self.output_dir.rstrip('/')}/batches"

    def lexicon(self) -> Lexicon:
        return Lexicon(min_chars=self.min_text_length, max_chars=self.max_text_length)

    def retry(self) -> Retry:
        return Retry(attempts=self.max_retries, first=self.retry_base_delay)


def load(environment: Mapping[str, str] | None = None, **given: object) -> Settings:
    """Settings from variables named like the fields in capitals; values that are given and not None win."""
    environment = os.environ if environment is None else environment
    settings = Settings()
    found: dict[str, object] = {}
    for f in fields(Settings):
        text = environment.get(f.name.upper())
        if text is not None:
            kind = type(getattr(settings, f.name))
            found[f.name] = text.strip().lower() in ("1", "true", "yes", "on") if kind is bool else kind(text)
    return replace(settings, **(found | {k: v for k, v in given.items() if v is not None}))
