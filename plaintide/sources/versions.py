"""Versions of a set of tables that are published at once.

A version is a folder with the files of its tables and a manifest, which says where every table of the set lies, in
this version's folder or in an earlier one's. It counts from the moment its marker file is there: readers take all
tables of one manifest, so they never see tables of two runs, and a writer that is killed leaves no trace that
counts. Versions are numbered in the order in which they are published; of two writers at once each gets a number.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from plaintide.sources.files import children, create_new, delete, read_text, write_text

VERSION = "version="
NUMBERS = "_numbers"
MANIFEST, PUBLISHED = "manifest.json", "_published"


@dataclass
class Manifest:
    """Where the tables of a version lie.

    `tables` has a path by table; `parts` has, by key range, the load it was made from and the paths of its pieces;
    `run_ts` is the time of the run in UTC, as text that sorts by time.
    """

    run_ts: str
    tables: dict[str, str] = field(default_factory=dict)
    parts: dict[str, dict[str, str]] = field(default_factory=dict)
    number: int = 0

    def paths(self) -> set[str]:
        return {*self.tables.values(), *(p for part in self.parts.values() for k, p in part.items() if k != "load")}


def new_folder(root: str) -> str:
    """A folder for the files of a version that is not published yet."""
    return f"{root}/{VERSION}{uuid.uuid4().hex}"


def publish(spark: SparkSession, root: str, folder: str, manifest: Manifest) -> Manifest:
    """Make the version in `folder` the latest one."""
    number = max([0, *(int(n) for n in children(spark, f"{root}/{NUMBERS}") if n.isdigit())]) + 1
    while not create_new(spark, f"{root}/{NUMBERS}/{number:010d}"):
        number += 1
    manifest.number = number
    write_text(spark, f"{folder}/{MANIFEST}", json.dumps(vars(manifest), sort_keys=True))
    create_new(spark, f"{folder}/{PUBLISHED}")
    return manifest


def published(spark: SparkSession, root: str) -> dict[str, Manifest]:
    """All published versions by folder, oldest first."""
    folders = [f"{root}/{n}" for n in children(spark, root) if n.startswith(VERSION)]
    found = {f: Manifest(**json.loads(read_text(spark, f"{f}/{MANIFEST}"))) for f in folders if PUBLISHED in children(spark, f)}
    return dict(sorted(found.items(), key=lambda item: item[1].number))


def version_at(spark: SparkSession, root: str, as_of: str | None = None) -> Manifest | None:
    """The latest version, or the latest of the runs up to the time `as_of`; None if there is none."""
    found = [m for m in published(spark, root).values() if as_of is None or m.run_ts <= as_of]
    return found[-1] if found else None


def roll_back(spark: SparkSession, root: str, number: int) -> Manifest:
    """Publish the tables of an earlier version again, as the latest one; nothing is copied."""
    earlier = next(m for m in published(spark, root).values() if m.number == number)
    folder = new_folder(root)
    return publish(spark, root, folder, Manifest(earlier.run_ts, earlier.tables, earlier.parts))


def expire(spark: SparkSession, root: str, keep: int = 10) -> None:
    """Drop all but the latest `keep` versions, and the files of theirs that no version kept refers to."""
    found = published(spark, root)
    kept = list(found)[-keep:]
    wanted = set().union(*(found[f].paths() for f in kept))
    for folder, manifest in found.items():
        if folder not in kept:
            delete(spark, f"{folder}/{PUBLISHED}")
            for path in manifest.paths() - wanted:
                delete(spark, path)
            if not any(path.startswith(f"{folder}/") for path in wanted):
                delete(spark, folder)
