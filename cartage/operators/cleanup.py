"""Removing staged files, always as a plan first."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartage.sources.files import open_file, spread


def cleanup_plan(listing: DataFrame, known_files: DataFrame) -> DataFrame:
    """Staged files that no log row refers to. ``known_files`` has a ``source_uri``."""
    return listing.join(known_files.select(F.col("source_uri").alias("path")), "path", "left_anti")


def selected_files(listing: DataFrame, selection: Column | DataFrame) -> DataFrame:
    """Files chosen by a condition on the listing or by a table of paths."""
    if isinstance(selection, Column):
        return listing.filter(selection)
    return listing.join(selection.select("path"), "path", "left_semi")


def remove_files(files: DataFrame, confirm: bool = False) -> DataFrame:
    """Delete the planned files on the executors; one row per file with the error, if any.

    Without ``confirm=True`` nothing is deleted. A file that is gone already
    counts as removed, so a rerun task does no harm.
    """
    if not confirm:
        raise ValueError("pass confirm=True to delete files")

    def remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            problems = []
            for path in batch["path"]:
                try:
                    filesystem, name = open_file(path)
                    filesystem.delete_file(name)
                    problems.append(None)
                except FileNotFoundError:
                    problems.append(None)
                except Exception as problem:
                    problems.append(f"{type(problem).__name__}: {problem}")
            yield pd.DataFrame({"path": batch["path"], "problem": problems})

    return spread(files.select("path")).mapInPandas(remove, "path string, problem string")
