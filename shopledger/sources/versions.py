"""Datasets whose readers never see half of a new version.

A version is written to a folder of its own under ``path/_versions`` and counts from the
moment an empty marker file of its name lies in ``path/_published``: one file creation,
which every file system does whole or not at all. Until then, and if the write fails, the
one before stays current. Versions are named by time, so the greatest marker is the current
one. The last ``keep`` versions stay for readers that have begun on them.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import SparkSession

from shopledger.sources.staging import file_system

VERSIONS, MARKERS = "_versions", "_published"


def _names(spark: SparkSession, folder: str) -> list[str]:
    path, files = file_system(spark, folder)
    if not files.exists(path):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(path))


def new_version(spark: SparkSession, path: str) -> str:
    """The name of a version that comes after all published ones."""
    name = f"v{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid4().hex[:8]}"
    last = max(_names(spark, f"{path}/{MARKERS}"), default="")
    # A clock that runs behind another machine's must not publish into the past.
    return name if name > last else f"{last}~{uuid4().hex[:8]}"


def version_folder(path: str, version: str) -> str:
    return f"{path}/{VERSIONS}/{version}"


def current_folder(spark: SparkSession, path: str) -> str:
    """Where the current version of ``path`` lies; ``path`` itself if it has none."""
    published = _names(spark, f"{path}/{MARKERS}")
    return version_folder(path, published[-1]) if published else path


def publish(
    spark: SparkSession,
    path: str,
    write: Callable[[str], int],
    *,
    switch: Callable[[str], None] | None = None,
    keep: int = 2,
) -> int:
    """Calls ``write`` with a new version's folder, then makes that version current.

    ``switch`` gets the folder too, to point a catalog there, just before the marker. If
    either fails, the half-written folder is deleted and nothing else has changed; one that
    a killed job leaves goes when the next version is published and is no younger than the
    versions kept. Returns what ``write`` does.
    """
    version = new_version(spark, path)
    folder = version_folder(path, version)
    where, files = file_system(spark, folder)
    try:
        found = write(folder)
        if switch is not None:
            switch(folder)
    except BaseException:
        files.delete(where, True)
        raise
    marker, _ = file_system(spark, f"{path}/{MARKERS}/{version}")
    files.create(marker, False).close()
    _drop_old(spark, path, keep)
    return found


def _drop_old(spark: SparkSession, path: str, keep: int) -> None:
    """Deletes versions older than the last ``keep`` published ones, markers first."""
    published = _names(spark, f"{path}/{MARKERS}")
    oldest_kept = published[-keep:][0]
    for folder in (f"{path}/{MARKERS}", f"{path}/{VERSIONS}"):
        for name in _names(spark, folder):
            if name < oldest_kept:
                old, files = file_system(spark, f"{folder}/{name}")
                files.delete(old, True)
