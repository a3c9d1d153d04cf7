"""Texts that runs and reports show: names, messages, durations, cell values."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lengths and wordings that logs and audits rely on.
ERROR_LIMIT = 500
FALLBACK_PREFIX = "ADD_FILES_COPY failed: "
FALLBACK_SUFFIX = ". Retrying with FULL_INGEST..."
BOTH_FAILED_NOTE = " (after ADD_FILES_COPY fallback)"
RUN_TIME_FORMAT = "yyyyMMdd_HHmmss"
RUN_PREFIX = "MIGRATE"
CELL_LIMIT = 30
HEADER_LIMIT = 20
ELLIPSIS = "..."


def clip_error(text: Column) -> Column:
    return F.substring(text, 1, ERROR_LIMIT)


def fallback_message(error: Column) -> Column:
    """Message of a file whose copy failed and that will be ingested instead."""
    return F.concat(F.lit(FALLBACK_PREFIX), clip_error(error), F.lit(FALLBACK_SUFFIX))


def both_failed_message(error: Column) -> Column:
    return F.concat(clip_error(error), F.lit(BOTH_FAILED_NOTE))


def run_name(prefix: str, operation: Column, *names: Column, at: Column) -> Column:
    """``PREFIX_OPERATION_NAMES_timestamp`` in upper case; ``at`` is a timestamp."""
    return F.upper(F.concat_ws("_", F.lit(prefix), operation, *names, F.date_format(at, RUN_TIME_FORMAT)))


def run_title(prefix: str, operation: str, names: list[str], at: datetime) -> str:
    """The name that ``run_name`` gives, for a run that is about to begin; names keep what a folder name may hold."""
    plain = [re.sub("[^A-Za-z0-9]+", "_", n).strip("_")[:80] for n in names]
    return "_".join([prefix, operation, *[n for n in plain if n], at.strftime("%Y%m%d_%H%M%S")]).upper()


def elapsed_text(seconds: Column) -> Column:
    """Duration in words; zero units are left out, except the seconds."""
    def unit(count: Column, word: str) -> Column:
        plural = F.when(count == 1, F.lit(f" {word}")).otherwise(F.lit(f" {word}s"))
        return F.concat(count.cast("string"), plural)

    whole = F.floor(seconds).cast("bigint")
    days = F.floor(whole / 86400).cast("bigint")
    hours = F.floor(whole % 86400 / 3600).cast("bigint")
    minutes = F.floor(whole % 3600 / 60).cast("bigint")
    return F.concat_ws(
        ", ",
        F.when(days > 0, unit(days, "day")),
        F.when(hours > 0, unit(hours, "hour")),
        F.when(minutes > 0, unit(minutes, "minute")),
        unit(whole % 60, "second"),
    )


def shortened(text: Column, limit: int = CELL_LIMIT) -> Column:
    """Text cut to ``limit`` characters, the last three being dots when it was longer."""
    keep = limit - len(ELLIPSIS)
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, keep), F.lit(ELLIPSIS))).otherwise(text)


def shown(value: Column, default) -> Column:
    """Cell value with a stand-in for NULL."""
    return F.coalesce(value, F.lit(default))
