"""Tables replaced as a whole: numbered folders, the newest complete one in force.

A version is complete once its ``_SUCCESS`` marker exists. A writer that dies
half-way, or a reader that is still busy with the previous version, is harmless.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

from pyspark.sql import SparkSession

from fiscora.sources.paths import child_names, delete, exists

_VERSION_DIR = re.compile(r"version=(\d+)$")


def version_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/version={version}"


def versions(spark: SparkSession, root: str) -> Iterator[int]:
    """Complete versions under ``root``, newest first. One listing; markers are looked up as versions are asked for."""
    numbered = [_VERSION_DIR.search(name) for name in child_names(spark, root)]
    for version in sorted((int(match.group(1)) for match in numbered if match), reverse=True):
        if exists(spark, f"{version_path(root, version)}/_SUCCESS"):
            yield version


def latest_version(spark: SparkSession, root: str) -> int | None:
    return next(versions(spark, root), None)


def remove_old(spark: SparkSession, root: str, keep: int) -> None:
    """Remove all but the newest ``keep`` complete versions, and whatever is older than those."""
    kept = list(islice(versions(spark, root), keep))
    if len(kept) == keep:
        for name in child_names(spark, root):
            match = _VERSION_DIR.search(name)
            if match and int(match.group(1)) < kept[-1]:
                delete(spark, f"{root.rstrip('/')}/{name}")


def next_version(spark: SparkSession, root: str) -> int:
    latest = latest_version(spark, root)
    return 0 if latest is None else latest + 1
