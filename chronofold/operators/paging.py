"""Keyset pages: top-k by a fixed order, continued behind a key."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Key:
    """A sort column; null counts as the smallest value, so it is last when descending and first when ascending."""

    column: str
    descending: bool = False

    def order(self) -> Column:
        c = F.col(self.column)
        return c.desc_nulls_last() if self.descending else c.asc_nulls_first()

    def behind(self, value) -> Column:
        c, v = F.col(self.column), F.lit(value)
        if self.descending:
            return F.lit(False) if value is None else (c < v) | c.isNull()
        return c.isNotNull() if value is None else c > v

    def equal(self, value) -> Column:
        return F.col(self.column).eqNullSafe(F.lit(value))


ORDERS = {
    "notices": (Key("notice_key", True),),
    "events": (Key("effective_date", True), Key("event_id", True)),
    "insider_transactions": (Key("filing_date", True), Key("event_id", True)),
    "significant_holdings": (Key("threshold_date", True), Key("notice_key", True)),
    "treasury_stock_positions": (Key("notification_date", True), Key("notice_key", True)),
    "treasury_operations": (Key("operation_date", True), Key("notice_key", True), Key("row_index")),
    "feed": (Key("observed_at"), Key("item_key")),
    "ledger_events": (Key("effective_date"), Key("event_id")),
}


def after(keys: tuple[Key, ...], values: list) -> Column:
    """Rows strictly behind a key. A bound on the first column alone is added where it holds, as a scan can use it to skip row groups."""
    steps = []
    for i, k in enumerate(keys):
        same = [q.equal(v) for q, v in zip(keys[:i], values[:i])]
        steps.append(reduce(lambda a, b: a & b, [*same, k.behind(values[i])]))
    out = reduce(lambda a, b: a | b, steps)
    first, v = keys[0], values[0]
    if v is not None and not first.descending:
        out = (F.col(first.column) >= F.lit(v)) & out
    return out


def page(df: DataFrame, keys: tuple[Key, ...], limit: int, behind: list | None = None) -> DataFrame:
    """limit + 1 rows of the page, so that the caller sees whether another follows."""
    if behind is not None:
        df = df.where(after(keys, behind))
    return df.orderBy(*[k.order() for k in keys]).limit(limit + 1)
