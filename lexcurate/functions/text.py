"""Text as columns. Lengths count code points; white space is Unicode's unless stated."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexcurate.functions.lexicons import java_pattern

SPACE = r"[\s\x1c-\x1f]"
TOKEN_CHARS, COST_PER_MILLION, TRUNCATION = 4, 2.7, 3000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row; without it each use would compute it again."""
    return F.transform(F.array(value), body)[0]


def strip(text: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(text, rf"(?U)^{SPACE}+|{SPACE}+$", "")


def is_blank(text: Column) -> Column:
    """Null, empty or nothing but white space."""
    return F.coalesce(strip(text), F.lit("")) == ""


def text_hash(text: Column) -> Column:
    """MD5 of the stripped text in lower case."""
    return F.md5(F.lower(strip(text)))


def exact_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def word_count(text: Column) -> Column:
    """Runs without white space; 0 for blank texts, null for null."""
    return F.size(F.filter(F.split(text, rf"(?U){SPACE}+"), lambda w: w != ""))


def truncated(text: Column, limit: int = TRUNCATION) -> Column:
    """Texts beyond ``limit`` cut there, then back to the last space if there is one, and ``...`` added."""
    return F.when(F.length(text) <= limit, text).otherwise(F.concat(F.regexp_replace(F.left(text, F.lit(limit)), " [^ ]*$", ""), F.lit("...")))


def token_estimate(text: Column) -> Column:
    """One token for four characters, at least one."""
    return F.greatest(F.lit(1), F.floor(F.length(text) / TOKEN_CHARS).cast("int"))


def cost(tokens: Column, per_million: float = COST_PER_MILLION) -> Column:
    return tokens / 1_000_000 * per_million


def any_contains(text: Column, parts: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.contains(text, F.lit(p)) for p in parts))


def count_contains(text: Column, parts: Sequence[str]) -> Column:
    """How many different ``parts`` occur."""
    return reduce(lambda a, b: a + b, (F.contains(text, F.lit(p)).cast("int") for p in parts))


def matches(text: Column, low: Column, pattern: str, ignore_case: bool, part: str = "") -> Column:
    """Whether the pattern is found; ``part`` stands in every match (in ``low``, the text in lower case, if case is ignored)."""
    return F.contains(low if ignore_case else text, F.lit(part)) & text.rlike(java_pattern(pattern, ignore_case))


def any_match(text: Column, patterns: Sequence[tuple[str, bool, str]]) -> Column:
    return let(F.lower(text), lambda low: reduce(lambda a, b: a | b, (matches(text, low, *p) for p in patterns)))


def ceil_div(a: Column, b: Column | int) -> Column:
    return F.ceil(a / b).cast("long")


def percent(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent, 0 where there is nothing."""
    return F.coalesce(F.try_divide(part * 100.0, whole), F.lit(0.0))


def bar(pct: Column) -> Column:
    """One block for every two percent."""
    return F.repeat(F.lit("█"), F.floor(pct / 2).cast("int"))


def byte_size(size: Column) -> Column:
    """Bytes with one decimal in the largest of B, KB, MB, GB, TB below which it is under 1,024."""
    units = ["B", "KB", "MB", "GB", "TB"]
    shown = [F.format_string("%.1f " + u, F.bround(size / float(1024**k), 1)) for k, u in enumerate(units)]
    out = F.when(size < 1024, shown[0])
    for k in range(1, 4):
        out = out.when(size < 1024 ** (k + 1), shown[k])
    return out.otherwise(shown[4])


def without_fence(content: Column) -> Column:
    """A reply without the first and last line if it starts with a code fence and has more than two lines."""
    lines = F.split(content, "\n", -1)
    return F.when(F.startswith(content, F.lit("```")) & (F.size(lines) > 2), F.array_join(F.slice(lines, F.lit(2), F.size(lines) - 2), "\n")).otherwise(content)


def batch_name(number: Column) -> Column:
    return F.concat(F.lit("batch_"), F.lpad(number.cast("string"), 6, "0"), F.lit(".parquet"))


def metric_line(names: Sequence[str], values: Sequence[Column], epoch: Column | None = None) -> Column:
    """``name: value`` with four decimals, joined by bars; after ``Epoch n`` if there is one."""
    parts = [F.format_string(f"{n}: %.4f", v) for n, v in zip(names, values)]
    return F.concat_ws(" | ", *([F.format_string("Epoch %d", epoch)] if epoch is not None else []), *parts)
