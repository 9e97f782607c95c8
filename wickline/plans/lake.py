"""Folders of one candle lake."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Lake:
    """``catalog`` names a schema of the catalog: bronze and silver are then bucketed tables there (``buckets``
    of every period), whose stored rows the merges do not shuffle. To be decided before the first load."""

    root: str
    catalog: str | None = None
    buckets: int = 64

    @property
    def landing(self) -> str:
        return f"{self.root}/landing"

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    @property
    def rejects(self) -> str:
        return f"{self.root}/rejects"

    @property
    def faults(self) -> str:
        return f"{self.root}/faults"

    @property
    def history(self) -> str:
        return f"{self.root}/history"

    def checks(self, table: str) -> str:
        return f"{self.root}/checks/{table}"

    def gold(self, table: str) -> str:
        return f"{self.root}/gold/{table}"
