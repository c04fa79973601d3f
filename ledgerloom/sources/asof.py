"""The plans' tables as they were known on an earlier day, so that a past report can be run again."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.sources.warehouse import Tables

# The column that tells since when a row is known: the date of a document, the change that made a version.
KNOWN_SINCE = {
    "ledger_current": "document_date", "ledger_history": "document_date", "ledger_history_old": "document_date",
    "ledger_corrections": "document_date", "deal_versions": "last_modified_date",
}


class AsOf(Mapping):
    """`tables` without what came later than `day`. Rows of a table in `known_since` count from their date on, through the
    end of that day; rows without a date always count, and other tables are as they are. The condition is on the stored
    column, so it reaches the scan. A plan that takes the latest version of something gets the one that was valid then."""

    def __init__(self, tables: Tables, day: dt.date, known_since: Mapping[str, str] = KNOWN_SINCE):
        self._tables, self._day, self._known = tables, day, dict(known_since)

    def __getitem__(self, name: str) -> DataFrame:
        df = self._tables[name]
        if name not in self._known:
            return df
        since = F.col(self._known[name])
        return df.filter(since.isNull() | (since < F.lit(self._day + dt.timedelta(days=1))))

    def __iter__(self) -> Iterator[str]:
        return iter(self._tables)

    def __len__(self) -> int:
        return len(self._tables)
