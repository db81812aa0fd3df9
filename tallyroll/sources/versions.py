"""Changes to tables that become visible all at once, and writers that may run side by side.

    <base>/_log/0000000007.json      what the seventh writer added: its folder, its days, the files of each table
    <base>/run=<id>/...              the files of one writer

A writer puts its files into a folder of its own that nobody reads, and then publishes the next number of the
log. A number is published by one step that fails if the number is taken (a hard link on a local file system,
else a rename, which HDFS makes atomic; an object store needs a connector whose rename onto an existing name fails). Who finds it taken reads what the others
added, and goes on or starts again. Readers take the folders from the log, so a writer that dies
leaves files that are never read (``clear`` deletes them), and what a reader has resolved does not change under it.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable, Collection, Iterable, Mapping, Sequence
from datetime import date
from functools import reduce
from types import MappingProxyType
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroll.session import remove
from tallyroll.sources.raw import MissingInput

_LOG, _SCHEMA = "_log", "folder string, days array<string>, files map<string,map<string,bigint>>, marks map<string,string>, buckets int, contents map<string,string>"


# Ranges of days that a scan is given at most.
MOST_RANGES = 12


class Commit(NamedTuple):
    """``files``: the name and length of each file, by table (the path below the folder); ``marks``: what a day was made of; ``buckets``: how many of them, if any;
    ``contents``: number and digest of the rows of each table."""

    number: int
    folder: str
    days: tuple[str, ...]
    files: Mapping[str, Mapping[str, int]]
    marks: Mapping[str, str] = MappingProxyType({})
    buckets: int = 0
    contents: Mapping[str, str] = MappingProxyType({})


def new_folder() -> str:
    return f"run={uuid.uuid4().hex}"


def log(spark: SparkSession, base: str) -> list[Commit]:
    """All commits, oldest first; a row for each on the driver."""
    path = f"{base}/{_LOG}"
    target, system = _file_system(spark, path)
    if not system.exists(target):
        return []
    lines = spark.read.schema(_SCHEMA).json(path).select("*", "_metadata.file_name")
    found = [Commit(int(r.file_name.split(".")[0]), r.folder, tuple(r.days), r.files or {}, r.marks or {}, r.buckets or 0, r.contents or {}) for r in lines.collect()]
    return sorted(found, key=lambda c: c.number)


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def files(spark: SparkSession, path: str) -> dict[str, int]:
    """Data files in a folder and their length; none if there is no such folder."""
    target, system = _file_system(spark, path)
    if not system.exists(target):
        return {}
    listed = ((s.getPath().getName(), s.getLen()) for s in system.listStatus(target) if s.isFile())
    return {name: length for name, length in listed if name[:1] not in ("_", ".")}


def _publish(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file under a new name, as a whole; False if the name is taken."""
    final, system = _file_system(spark, path)
    staged = spark._jvm.org.apache.hadoop.fs.Path(final.getParent(), f".{uuid.uuid4().hex}")
    out = system.create(staged, False)
    out.write(bytearray(text.encode()))
    out.close()
    if system.getScheme() != "file":
        done = system.rename(staged, final)
    else:
        try:
            # A local rename would replace what is there.
            os.link(staged.toUri().getPath(), final.toUri().getPath())
            done = True
        except FileExistsError:
            done = False
    system.delete(staged, False)
    return done


def commit(
    spark: SparkSession,
    base: str,
    folder: str,
    days: Iterable[str],
    added: Mapping[str, Mapping[str, int]],
    seen: Sequence[Commit] | None = None,
    clash: Callable[[Commit], bool] = lambda other: False,
    marks: Mapping[str, str] | None = None,
    buckets: int = 0,
    contents: Mapping[str, str] | None = None,
) -> bool:
    """Publish a folder; False, and nothing published, if a commit that came after ``seen`` clashes."""
    known = log(spark, base) if seen is None else list(seen)
    text = json.dumps({"folder": folder, "days": sorted(days), "files": added, "marks": dict(marks or {}), "buckets": buckets, "contents": dict(contents or {})})
    while True:
        number = known[-1].number + 1 if known else 1
        if _publish(spark, f"{base}/{_LOG}/{number:010d}.json", text):
            return True
        before, known = number, log(spark, base)
        if any(clash(other) for other in known if other.number >= before):
            return False


def current(commits: Sequence[Commit], first: date | None = None, last: date | None = None, only: Collection[date] | None = None) -> dict[str, Commit]:
    """For each day, or those of a range, or some days, the last commit that has it."""
    wanted = None if only is None else {day.isoformat() for day in only}
    low, high = first.isoformat() if first else "", last.isoformat() if last else "9999-12-31"
    return {day: found for found in sorted(commits, key=lambda c: c.number) for day in found.days if low <= day <= high and (wanted is None or day in wanted)}


def runs_of(commit_: Commit, kept: Iterable[str]) -> list[tuple[str, str]]:
    """Ranges of days that hold just those of the commit's days that are ``kept``."""
    wanted, out, open_ = set(kept), [], False
    for day in sorted(commit_.days):
        if day in wanted:
            out = [*out[:-1], (out[-1][0], day)] if open_ else [*out, (day, day)]
        open_ = day in wanted
    return out


def read(spark: SparkSession, base: str, table: str = "", first: date | None = None, last: date | None = None, only: Collection[date] | None = None, day: str = "run_date") -> DataFrame:
    """Rows of a table, or of a range of its days, or of some days, each day as the last commit that has it left it."""
    found = current(log(spark, base), first, last, only)
    if not found:
        raise MissingInput(f"no such day at {base}/{table}")
    kept: dict[str, list[str]] = {}
    for label, commit_ in found.items():
        kept.setdefault(commit_.folder, []).append(label)
    commits = {c.folder: c for c in found.values()}
    # Folders that are read as a whole are one scan, however many; one of which days were replaced, or not asked for, is one more.
    whole = [f for f, days in kept.items() if len(days) == len(commits[f].days)]

    def path(folder: str) -> str:
        return "/".join(part for part in (base, folder, table) if part)

    frames = [spark.read.parquet(*map(path, sorted(whole)))] if whole else []
    for folder in sorted(set(kept) - set(whole)):
        frames.append(spark.read.parquet(path(folder)).where(_between(runs_of(commits[folder], kept[folder]), kept[folder], day)))
    return reduce(DataFrame.unionByName, frames)


def clear(spark: SparkSession, base: str, older_than_hours: float = 24.0) -> list[str]:
    """Delete folders that no commit names or whose days have all been replaced, if they were last touched that long ago.

    Readers and writers must not be at work on anything that old.
    """
    commits = log(spark, base)
    kept = {c.folder for c in current(commits).values()}
    target, system = _file_system(spark, base)
    gone, limit = [], (time.time() - 3600 * older_than_hours) * 1000
    for status in system.listStatus(target) if system.exists(target) else []:
        name = status.getPath().getName()
        if name.startswith("run=") and name not in kept and status.getModificationTime() <= limit:
            remove(spark, f"{base}/{name}")
            gone.append(name)
    return gone


def _between(ranges: Sequence[tuple[str, str]], days: Collection[str], column: str) -> Column:
    """Rows of ``days``, which lie in ``ranges``.

    The files are sorted by day, and ranges are what lets a scan skip row groups. Beyond some, those with the smallest gaps are taken
    together for that and the day is looked up in a set: hundreds of ranges in one condition are slow on each row.
    """
    if len(ranges) <= MOST_RANGES:
        return _in_ranges(ranges, column)
    gaps = sorted(range(1, len(ranges)), key=lambda i: date.fromisoformat(ranges[i - 1][1]) - date.fromisoformat(ranges[i][0]))
    starts = [0, *sorted(gaps[: MOST_RANGES - 1])]
    coarse = [(ranges[i][0], ranges[j - 1][1]) for i, j in zip(starts, [*starts[1:], len(ranges)], strict=True)]
    return _in_ranges(coarse, column) & F.col(column).isin([date.fromisoformat(day) for day in days])


def _in_ranges(ranges: Sequence[tuple[str, str]], column: str) -> Column:
    """Rows whose day lies in one of the ranges."""
    found = F.lit(False)
    for first, last in ranges:
        found = found | F.col(column).between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return found
