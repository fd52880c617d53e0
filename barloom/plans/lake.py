"""Where the layers of one pipeline live."""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from barloom.sources.tables import FILE_FORMATS


@dataclass(frozen=True)
class Lake:
    """Folders below one root, local or on any file system Spark can reach.

    Silver and quarantine are laid out as folders, ``generation=G/ingest_batch=N``, of
    which a job replaces its own. That needs a file format: table formats with a log of
    their own are refused.
    """

    root: str
    fmt: str = "parquet"
    glob: str = "*.json"
    # What makes two bars copies of each other. Runs that fetch the same day
    # at different seconds need ("symbol", "date").
    key: tuple[str, ...] = ("symbol", "datetime")
    # Pretty-printed documents: one document over all lines of a file.
    multi_line: bool = False
    # How long a folder directly below bronze is still looked into after the last file that
    # was found there. Later ones are found by a full listing.
    settle: datetime.timedelta = datetime.timedelta(days=7)
    # How long folders stay that a rebuild or a compaction has replaced, for readers that
    # have begun on them. A later run removes them.
    retention: datetime.timedelta = datetime.timedelta(days=1)

    def __post_init__(self) -> None:
        if self.fmt not in FILE_FORMATS:
            raise ValueError(f"format {self.fmt!r} cannot hold this layout: use one of {FILE_FORMATS}")

    def _below(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def bronze(self) -> str:
        """Raw documents."""
        return self._below("bronze")

    @property
    def silver(self) -> str:
        return self._below("silver")

    @property
    def quarantine(self) -> str:
        return self._below("quarantine")

    @property
    def gold(self) -> str:
        return self._below("gold")

    def gold_table(self, name: str) -> str:
        return f"{self.gold}/{name}"

    @property
    def pending(self) -> str:
        """The backlog of the run in progress, if it is more than one batch's files."""
        return self._below("pending")

    @property
    def files(self) -> str:
        """The versions of files that each finished batch covers."""
        return self._below("files")

    @property
    def superseded(self) -> str:
        """Files of which a batch has read a later version than batches before it."""
        return self._below("superseded")

    @property
    def retired(self) -> str:
        """Folders that are to be removed, and since when."""
        return self._below("retired")

    @property
    def runs(self) -> str:
        """Finished batches: the months and numbers of bars of their files."""
        return self._below("runs")

    @property
    def generations(self) -> str:
        """Finished rebuilds of silver; the last one is read."""
        return self._below("generations")
