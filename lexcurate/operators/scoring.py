"""Scoring documents: a protocol for scorers, retries, and an annotation run with its errors apart."""

from __future__ import annotations

import json
import queue
import threading
import time
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexcurate.functions import text as T
from lexcurate.functions.replies import parsed_reply


class ScorerError(Exception):
    """Base of what a scorer may raise; others end the task."""


class RateLimited(ScorerError):
    pass


class CallTimeout(ScorerError):
    pass


class Scorer(Protocol):
    """Made once per Python worker; answers with a JSON reply."""

    def reply(self, text: str) -> str: ...


@dataclass(frozen=True)
class Retry:
    """Waits of ``first * 2**k`` seconds up to ``longest``, ``attempts`` in all; only :class:`ScorerError` is tried again."""

    attempts: int = 20
    first: float = 0.5
    longest: float = 60.0
    sleep: Callable[[float], None] = field(default=time.sleep)

    def call(self, function: Callable[[], str]) -> str:
        for k in range(self.attempts):
            try:
                return function()
            except ScorerError:
                if k + 1 == self.attempts:
                    raise
                self.sleep(min(self.longest, self.first * 2**k))
        raise ScorerError("no attempts")


#: our own wording; ``{text}`` is replaced
PROMPT = """How valuable is this text for learning about law, from 0 (not at all) to 5 (very)? Answer with a JSON object: {"score": 0-5, "reasoning": "one sentence"}.

{text}"""


class PromptScorer:
    """A scorer behind a call, as to a remote model: the text is put into ``prompt``, and a call that takes longer than ``timeout`` seconds
    raises :class:`CallTimeout`. Errors named in ``errors`` (type of the call's error: type to raise) become scorer errors, to be tried again or
    reported; others end the task. A call that ran out of time is left to itself; the next one has its own thread."""

    def __init__(self, call: Callable[[str], str], prompt: str = PROMPT, timeout: float = 30.0, errors: Mapping[type, type] | None = None) -> None:
        self.call, self.prompt, self.timeout = call, prompt, timeout
        self.errors = dict(errors or {ConnectionError: ScorerError, TimeoutError: CallTimeout})

    def reply(self, text: str) -> str:
        answer: queue.Queue = queue.Queue()

        def run() -> None:
            try:
                answer.put((self.call(self.prompt.replace("{text}", text)), None))
            except Exception as e:  # noqa: BLE001 - handed to the caller
                answer.put((None, e))

        threading.Thread(target=run, daemon=True).start()
        try:
            reply, error = answer.get(timeout=self.timeout)
        except queue.Empty:
            raise CallTimeout(f"no answer after {self.timeout} s") from None
        if error is not None:
            kind = next((to for of, to in self.errors.items() if isinstance(error, of)), None)
            raise kind(str(error)) from error if kind else error
        return reply


class TermScorer:
    """An offline scorer without a model: a point for every two different terms, five at most."""

    def __init__(self, terms: tuple[str, ...] | None = None) -> None:
        from lexcurate.functions.lexicons import KEYWORDS

        self.terms = terms or KEYWORDS

    def reply(self, text: str) -> str:
        low = text.lower()
        found = [t for t in self.terms if t in low]
        return json.dumps({"score": min(5, len(found) // 2), "reasoning": f"{len(found)} terms"})


def replies(docs: DataFrame, make: Callable[[], Scorer], retry: Retry = Retry(), limit: int = T.TRUNCATION) -> DataFrame:
    """``docs(id, text, url)`` with ``sent`` (the text cut to ``limit``), ``reply`` and ``failure`` (type and message of a scorer that gave up)."""
    sent = docs.select("id", "text", "url", T.truncated(F.coalesce("text", F.lit("")), limit).alias("sent"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = make()
        for batch in batches:
            answers, failures = [], []
            for text in batch["sent"]:
                try:
                    answers.append(retry.call(lambda text=text: scorer.reply(text)))
                    failures.append(None)
                except ScorerError as e:
                    answers.append(None)
                    failures.append(f"{type(e).__name__}: {e}")
            yield batch.assign(reply=pd.Series(answers, dtype=object, index=batch.index), failure=pd.Series(failures, dtype=object, index=batch.index))

    return sent.mapInPandas(run, "id string, text string, url string, sent string, reply string, failure string")


def annotated(docs: DataFrame, make: Callable[[], Scorer], model: str = "offline", retry: Retry = Retry(), at: Column | None = None) -> DataFrame:
    """``id, score, reasoning, text, url, timestamp, model, input_tokens, text_length, error``: an error is either the
    scorer's or the reply's, and leaves score and reasoning null; other documents go on."""
    rows = replies(docs, make, retry).withColumn("parsed", parsed_reply(F.col("reply")))
    return rows.select(
        "id", F.col("parsed.score").cast("tinyint").alias("score"), "parsed.reasoning", "text", "url",
        (at if at is not None else F.localtimestamp()).cast("timestamp_ntz").alias("timestamp"), F.lit(model).alias("model"),
        T.token_estimate(F.col("sent")).alias("input_tokens"), F.length("text").alias("text_length"), F.coalesce("failure", "parsed.error").alias("error"),
    )


def split_errors(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Annotations, and ``id, error`` of those that failed."""
    return rows.filter("error is null").drop("error"), rows.filter("error is not null").select("id", "error")
