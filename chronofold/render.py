"""Results as text: one writer per format, each a function from a result to (payload lines, notes).

A result is a page (QueryResult), one record (a dict or an object with to_dict) or a plain text. Notes don't belong to the payload.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from datetime import date, datetime
from decimal import Decimal
from io import StringIO
from xml.sax.saxutils import XMLGenerator

from . import __version__
from .api import SCHEMA_VERSION, QueryResult
from .errors import UnsupportedQuery

ATOM = "http://www.w3.org/2005/Atom"
#: What an entry's content tells besides its instants.
ENTRY_FIELDS = ("feed_item_type", "history_class", "run_type", "issuer_id", "notice_key", "event_id", "effective_date", "event_basis", "annulment_status", "summary")
Text = tuple[Iterator[str], list[str]]


def plain(value):
    """Instants and dates as ISO text, exact numbers as text, sets in order; no other type is passed over in silence."""
    if isinstance(value, (date, datetime)):
        return value.isoformat()
    if isinstance(value, Decimal):
        return str(value)
    if isinstance(value, (set, frozenset)):
        return sorted(value)
    if hasattr(value, "to_dict"):
        return value.to_dict()
    if hasattr(value, "asDict"):
        return value.asDict(True)
    raise TypeError(f"{type(value).__name__} has no JSON form")


def record(result) -> dict | str:
    return result.to_dict() if hasattr(result, "to_dict") else result


def _dump(data, **more) -> str:
    return json.dumps({"schema_version": SCHEMA_VERSION, **more, "data": data}, default=plain, ensure_ascii=False)


def document(result) -> Text:
    return iter([_dump(record(result), api_version=__version__)]), []


def lines(result) -> Text:
    page = isinstance(result, QueryResult)
    notes = [f"next_cursor={result.next_cursor}"] if page and result.next_cursor else []
    return (_dump(x) for x in (result.items if page else [record(result)])), notes


def _cell(value) -> str:
    return "-" if value is None else value if isinstance(value, str) else json.dumps(value, default=plain, ensure_ascii=False).strip('"')


def _grid(rows: list[list[str]]) -> Iterator[str]:
    wide = [max(map(len, column)) for column in zip(*rows)]
    for r in rows:
        yield " | ".join(c.ljust(w) for c, w in zip(r, wide)).rstrip()


def columns(result) -> Text:
    """Records under their column names, those that are null throughout left out; a single record as name and value."""
    if not isinstance(result, QueryResult):
        told = record(result)
        return _grid([[str(k), _cell(v)] for k, v in told.items()]) if isinstance(told, dict) else iter([told]), []
    used = list(dict.fromkeys(k for x in result.items for k, v in x.items() if v is not None))
    body = list(_grid([used, *([_cell(x.get(k)) for k in used] for x in result.items)])) if used else []
    state = result.history_mode or result.status
    return iter([*body, f"# {result.count} rows, {state}" + (f", continued behind {result.next_cursor}" if result.next_cursor else "")]), []


def atom(result) -> Text:
    """A feed page as Atom. Both instants of an entry tell when it became known, never when it took effect."""
    if not isinstance(result, QueryResult) or result.query != "feed":
        raise UnsupportedQuery("only the feed has an Atom form")
    of = result.dataset_version or "unknown"
    known = [plain(i["observed_at"]) if i["observed_at"] else "" for i in result.items]
    out = StringIO()
    xml = XMLGenerator(out, "utf-8", short_empty_elements=True)

    def leaf(name: str, text: str, **attributes: str) -> None:
        xml.startElement(name, attributes)
        xml.characters(text)
        xml.endElement(name)

    xml.startElement("feed", {"xmlns": ATOM})
    leaf("id", f"urn:chronofold:feed:{of}")
    leaf("title", f"What became known ({of})")
    leaf("updated", max(known, default=""))
    for item, at in zip(result.items, known):
        xml.startElement("entry", {})
        leaf("id", f"urn:chronofold:{item['feed_item_id']}")
        leaf("title", " ".join(filter(None, (item["feed_item_type"], item["notice_key"] or item["issuer_id"]))))
        leaf("published", at)
        leaf("updated", at)
        leaf("content", json.dumps({k: item.get(k) for k in ENTRY_FIELDS}, default=plain, ensure_ascii=False), type="application/json")
        xml.endElement("entry")
    xml.endElement("feed")
    return iter([out.getvalue()]), [f"next_cursor={result.next_cursor}"] if result.next_cursor else []


WRITERS: dict[str, Callable[[object], Text]] = {"table": columns, "json": document, "jsonl": lines, "atom": atom}
