"""Row filters and predicates (FL-01..06)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runledger.functions.text import BOT_TAG

# Retry codes that allow another attempt.
RETRYABLE_CODES = ("claude_code_error", "timeout_error", "execution_error", "error_during_execution")


def failed(df: DataFrame, passed_col: str = "passed") -> DataFrame:
    """FL-01: failed results (a null outcome is neither passed nor failed)."""
    return df.filter(~F.col(passed_col))


def passed(df: DataFrame, passed_col: str = "passed") -> DataFrame:
    """FL-01: passed results."""
    return df.filter(F.col(passed_col))


def blockers(df: DataFrame, sev_col: str = "issue_severity", severity: str = "blocker") -> DataFrame:
    """FL-02: findings of one severity."""
    return df.filter(F.col(sev_col) == severity)


def human_mentions(df: DataFrame, keyword: str, body_col: str = "body", tag: str | None = None) -> DataFrame:
    """FL-03: drop bot-tagged text (``BOT_TAG`` unless ``tag``), keep text containing the
    keyword (case-sensitive)."""
    tag = BOT_TAG if tag is None else tag
    b = F.col(body_col)
    return df.filter(~b.contains(tag) & b.contains(keyword))


def spec_paths(df: DataFrame, path_col: str = "path") -> DataFrame:
    """FL-05: spec documents: under ``specs/`` and ending in ``.md``; flags patch specs."""
    p = F.col(path_col)
    return df.filter(p.startswith("specs/") & p.endswith(".md")) \
             .withColumn("is_patch", p.contains("specs/patch/"))


def retryable(df: DataFrame, success_col: str = "success", code_col: str = "retry_code") -> DataFrame:
    """FL-06: outcomes worth another attempt."""
    return df.filter(~F.col(success_col) & (F.col(code_col) != "none") & F.col(code_col).isin(*RETRYABLE_CODES))
