"""Paths of staged files as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def collapse_slashes(path: Column) -> Column:
    return F.regexp_replace(path, "/{2,}", "/")


def last_segment(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def strip_prefix(url: Column, prefix: str | None = None) -> Column:
    """``url`` without a literal prefix, or without its scheme and host."""
    if prefix is None:
        return F.regexp_replace(url, "^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*", "")
    cut = F.substring(url, F.lit(len(prefix) + 1), F.length(url))
    return F.when(F.startswith(url, F.lit(prefix)), cut).otherwise(url)


def relative_path(name: Column, stage_path: str = "", stage_root: str | None = None) -> Column:
    """Path of a listed file relative to its stage.

    With a stage path: what follows the first ``/stage_path/``; failing that,
    what follows the last segment equal to the stage path's own last segment;
    failing that, the file name. Names without a scheme count as local and give
    the file name. Without a stage path the path below ``stage_root`` is kept,
    so that nested folders survive; with no root either, the file name is all.
    """
    file_name = last_segment(name)
    is_url = F.contains(name, F.lit("://"))
    if not stage_path:
        below = file_name
        if stage_root:
            root = stage_root.rstrip("/") + "/"
            below = F.when(F.startswith(name, F.lit(root)), strip_prefix(name, root)).otherwise(file_name)
        return collapse_slashes(below)

    prefix = F.lit(stage_path)
    marker = f"/{stage_path}/"
    at = F.instr(name, F.lit(marker))
    after_marker = F.substring(name, at + F.lit(len(marker)), F.length(name))

    parts = F.split(name, "/")
    segment = stage_path.rstrip("/").split("/")[-1]
    # counted from the end: 1 is the last part, 0 means the segment is absent
    from_end = F.array_position(F.reverse(parts), F.lit(segment))
    tail = F.array_join(F.slice(parts, F.size(parts) - from_end.cast("int") + 2, F.size(parts)), "/")

    under_stage = lambda rest: F.concat(prefix, F.lit("/"), rest)
    found = (
        F.when(~is_url, under_stage(file_name))
        .when(at > 0, under_stage(after_marker))
        .when(from_end == 1, prefix)
        .when(from_end > 1, under_stage(tail))
        .otherwise(under_stage(file_name))
    )
    return collapse_slashes(found)
