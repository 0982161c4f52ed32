"""Several folders of several tables put in place as one unit.

A writer first writes all its new folders below ``<root>/_staging``.  Then it writes one
small journal file, named by the commit's number, and renames it into ``<root>/_commits``:
that rename is the commit.  Only after it are folders moved; a journal names every move and
removal, and each can be repeated, so ``recover`` finishes what a crash left undone.  What
was staged without a journal was never committed, and is dropped by the next writer.

Commits are numbered 1, 2, 3 ...; a journal also carries named marks (small JSON values,
such as the number of the last commit of a table), and every journal repeats all marks of
the one before.  So data folders and marks can't disagree.

One writer at a time per root; ``recover`` is its first step and precedes its reads.  Needs
a file system whose renames are atomic, as HDFS or a local one.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from tickvault.sinks import files

KEEP = 20          # journals that stay for inspection


class Journal:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.folder, self.staging = f"{self.root}/_commits", f"{self.root}/_staging"

    def _numbers(self) -> list[int]:
        return sorted(int(n[:-5]) for n in files.list_files(self.spark, self.folder) if n.endswith(".json"))

    def _read(self, number: int) -> dict:
        return json.loads(files.read_text(self.spark, f"{self.folder}/{number:012d}.json"))

    def last(self) -> int:
        """Number of the last commit, 0 if there is none."""
        return max(self._numbers(), default=0)

    def marks(self) -> dict:
        last = self.last()
        return self._read(last)["marks"] if last else {}

    def recover(self) -> None:
        """Finish the last commit's moves.  Nothing to do unless a writer stopped in the middle of them."""
        last = self.last()
        if last and not files.path_exists(self.spark, f"{self.folder}/{last:012d}.done"):
            self._apply(last, self._read(last))

    def _apply(self, number: int, entry: dict) -> None:
        for target in entry["removes"]:
            files.delete_path(self.spark, self._full(target))
        for source, target in entry["moves"]:
            # A staged folder that is gone has been moved before.
            if files.path_exists(self.spark, self._full(source)):
                files.delete_path(self.spark, self._full(target))
                files.move(self.spark, self._full(source), self._full(target))
        files.touch(self.spark, f"{self.folder}/{number:012d}.done")

    def _full(self, path: str) -> str:
        return path if path.startswith("/") or ":/" in path else f"{self.root}/{path}"

    def begin(self) -> Commit:
        """A new unit of work; drops what an earlier, uncommitted one has left."""
        self.recover()
        files.delete_path(self.spark, self.staging)
        return Commit(self, self.last() + 1)

    def note(self, **marks) -> None:
        """A commit of marks alone."""
        commit = self.begin()
        commit.marks.update(marks)
        commit.done()


def _upwards(path: str) -> list[str]:
    """``path`` and the folders it lies in."""
    parts = path.split("/")
    return ["/".join(parts[:k]) for k in range(len(parts), 0, -1)]


class Commit:
    """Folders and marks that take effect together, by ``done``."""

    def __init__(self, journal: Journal, number: int):
        self.journal, self.number = journal, number
        self.stage = f"{journal.staging}/{number:012d}-{uuid.uuid4().hex}"
        self.marks = dict(journal.marks())
        self.moves: list[list[str]] = []
        self.removes: list[str] = []

    def folder(self, name: str) -> str:
        """Where to write a folder that will be moved."""
        return f"{self.stage}/{name}"

    def _relative(self, path: str) -> str:
        root = self.journal.root + "/"
        return (path[len(root):] if path.startswith(root) else path).rstrip("/")

    def replace(self, source: str, target: str) -> None:
        self.moves.append([self._relative(source), self._relative(target)])

    def replace_parts(self, source: str, target: str) -> list[str]:
        """Every folder directly below ``source`` takes its place below ``target``; their names."""
        names = files.list_folders(self.journal.spark, source)
        for name in names:
            self.replace(f"{source}/{name}", f"{target.rstrip('/')}/{name}")
        return names

    def remove(self, target: str) -> None:
        self.removes.append(self._relative(target))

    def seal(self) -> None:
        """The commit itself: after it, ``recover`` will finish the moves, before it nothing has happened."""
        gone = set(self.removes)
        inside = {x for path in gone for x in _upwards(path)}
        for _, target in self.moves:
            # A removal that is repeated after the move would take the new folder.
            if target in inside or not gone.isdisjoint(_upwards(target)):
                raise ValueError(f"{target} is both moved to and removed")
        j, name = self.journal, f"{self.number:012d}.json"
        files.write_text(j.spark, f"{self.stage}/{name}", json.dumps(
            {"removes": self.removes, "moves": self.moves, "marks": self.marks}))
        files.move(j.spark, f"{self.stage}/{name}", f"{j.folder}/{name}")

    def done(self) -> int:
        """Commit, then move; returns the commit's number."""
        self.seal()
        j = self.journal
        j.recover()
        for old in j._numbers()[:-KEEP]:
            for end in ("done", "json"):
                files.delete_path(j.spark, f"{j.folder}/{old:012d}.{end}")
        files.delete_path(j.spark, self.stage)
        return self.number
