"""Month folders that change together: written beside the table, then renamed into place.

A write puts its files below ``<table>/_swap-<id>/new`` (readers skip names that begin with ``_``).
When all are there, a plan (which months are replaced, added to or emptied) is written as one small
file; only from then on does the write count. Rolling the plan forward renames whole month folders:
the old one out of the way, the new one in. A job that fails before the plan leaves the table as it
was, and its folder is removed by the next write. A job that fails after it is completed by the next
write (or by :func:`recover`): every step is a rename that is skipped when it has been done. A reader
sees a month's old files or its new ones, never some of each.

One writer per table at a time. Folder renames are single operations of the file system (on stores
without them, a month is moved file by file). The work here is one call per month and file of the
*write*; no data passes through the driver.

A ``token`` names a write that must happen once (a stream's micro-batch): it is kept with the
table when the plan is completed, and :func:`applied` says whether it is there.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from collections.abc import Iterable

from pyspark.sql import SparkSession

MONTH_FOLDER = re.compile(r"year=(\d+)/month=(\d+)$")
PLAN = "_plan.json"


class Folder:
    """A path with the few file-system calls that are needed here."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._fs = self._p(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _p(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def qualified(self) -> str:
        return self._fs.makeQualified(self._p(self.path)).toString()

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._p(path))

    def names(self, path: str) -> list[str]:
        """Names in a folder; none if there is no such folder."""
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._p(path)))

    def files(self, path: str) -> list[tuple[str, int, int]]:
        """``(name, bytes, time of change)`` of the data files directly in a folder."""
        if not self.exists(path):
            return []
        return sorted((s.getPath().getName(), s.getLen(), s.getModificationTime())
                      for s in self._fs.listStatus(self._p(path))
                      if s.isFile() and not s.getPath().getName().startswith(("_", ".")))

    def size(self, path: str) -> int:
        return self._fs.getContentSummary(self._p(path)).getLength() if self.exists(path) else 0

    def delete(self, path: str) -> None:
        self._fs.delete(self._p(path), True)

    def rename(self, a: str, b: str) -> None:
        self._fs.mkdirs(self._p(b).getParent())
        if not self._fs.rename(self._p(a), self._p(b)):
            raise OSError(f"cannot rename {a} to {b}")

    def write(self, path: str, text: str) -> None:
        """Create a small file whole: under another name first, then renamed."""
        part = f"{path}.part"
        out = self._fs.create(self._p(part), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        if self.exists(path):
            self.delete(path)
        self.rename(part, path)

    def read(self, path: str) -> str:
        source = self._fs.open(self._p(path))
        try:
            return bytes(source.readAllBytes()).decode()
        finally:
            source.close()

    def glob(self, pattern: str) -> list[tuple[str, int, int]]:
        """``(path, bytes, time of change)`` of the files a pattern names."""
        found = self._fs.globStatus(self._p(pattern))
        return sorted((s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in found or [] if s.isFile())

    def months(self, path: str | None = None) -> dict[dt.date, str]:
        """The month folders below ``path`` (the table by default), by month."""
        top = path or self.path
        out = {}
        for year in self.names(top):
            if year.startswith("year="):
                for month in self.names(f"{top}/{year}"):
                    found = MONTH_FOLDER.search(f"{year}/{month}")
                    if found:
                        out[dt.date(int(found[1]), int(found[2]), 1)] = f"{year}/{month}"
        return out


def month_folder(month: dt.date) -> str:
    return f"year={month.year}/month={month.month:02d}"


def begin(table: Folder) -> str:
    """A fresh folder for a write, after earlier writes have been settled."""
    recover(table)
    return f"{table.path}/_swap-{uuid.uuid4().hex}"


def commit(table: Folder, swap: str, replace: Iterable[dt.date], empty: Iterable[dt.date] = (),
           append: Iterable[dt.date] = (), token: str | None = None, side: Iterable[str] = ()) -> None:
    """Make the write in ``swap`` count, then bring its months into the table."""
    plan = {k: sorted(month_folder(m) for m in v) for k, v in (
        ("replace", replace), ("empty", empty), ("append", append))}
    table.write(f"{swap}/{PLAN}", json.dumps({**plan, "token": token, "side": sorted(side)}))
    roll_forward(table, swap)


def roll_forward(table: Folder, swap: str) -> None:
    """Complete a planned write; steps that have been done are skipped."""
    plan = json.loads(table.read(f"{swap}/{PLAN}"))
    for folder in plan["replace"]:
        live, new = f"{table.path}/{folder}", f"{swap}/new/{folder}"
        if table.exists(new):
            if table.exists(live):
                table.rename(live, f"{swap}/old/{folder}")
            table.rename(new, live)
    for folder in plan["empty"]:
        if table.exists(f"{table.path}/{folder}"):
            table.rename(f"{table.path}/{folder}", f"{swap}/old/{folder}")
    for folder in plan["append"]:
        new = f"{swap}/new/{folder}"
        for sub in ("", "/_ranges"):
            for name, *_ in table.files(new + sub):
                table.rename(f"{new}{sub}/{name}", f"{table.path}/{folder}{sub}/{name}")
    for name in plan["side"]:
        if table.exists(f"{swap}/side/{name}"):
            if table.exists(f"{table.path}/{name}"):
                table.rename(f"{table.path}/{name}", f"{swap}/old/{name}")
            table.rename(f"{swap}/side/{name}", f"{table.path}/{name}")
    if plan["token"]:
        table.write(f"{table.path}/_applied/{plan['token']}", "")
    table.delete(swap)


def recover(table: Folder) -> None:
    """Settle writes that were cut off: planned ones are completed, others removed."""
    for name in table.names(table.path):
        if name.startswith("_swap-"):
            swap = f"{table.path}/{name}"
            if table.exists(f"{swap}/{PLAN}"):
                roll_forward(table, swap)
            else:
                table.delete(swap)


def applied(table: Folder, token: str) -> bool:
    return table.exists(f"{table.path}/_applied/{token}")
