"""Command line. The payload alone goes to stdout, notes and errors to stderr. Exit codes: 0 done, 1 refused, 2 wrong usage.

Reading commands are declared in READ: what they are given, which method answers, and which of the shared flags it takes.
Jobs that write are below `admin`.
"""

from __future__ import annotations

import argparse
import sys
from dataclasses import dataclass
from datetime import date, datetime, timezone

from . import __version__, jobs
from .api import SCHEMA_VERSION, Ledger
from .errors import LedgerError
from .render import WRITERS

PAGE, KNOWN, EFFECTIVE, CANCELLED = ("limit", "cursor"), ("known_at",), ("effective_at",), ("include_cancelled",)


@dataclass(frozen=True)
class Command:
    method: str
    takes: str | None = None  # the name of its one argument; a trailing ? makes it optional
    flags: tuple[str, ...] = ()
    #: by which parameter the argument is passed, None for the first one
    into: str | None = None


READ = {
    "company": Command("company", "ident"),
    "notice": Command("notice_record", "notice_key"),
    "annulment": Command("annulment_status", "notice_key"),
    "authoritative": Command("current_authoritative", "notice_key"),
    "provenance": Command("provenance_of", "key"),
    "dataset-info": Command("dataset_info"),
    "coverage": Command("coverage_record"),
    "notices": Command("notices", "ident?", PAGE + KNOWN, "issuer"),
    "events": Command("events", "ident?", PAGE + KNOWN + EFFECTIVE, "issuer"),
    "insiders": Command("insider_transactions", "ident?", PAGE + KNOWN + EFFECTIVE + CANCELLED, "issuer"),
    "recent-insiders": Command("recent_insider_transactions", None, PAGE + KNOWN + EFFECTIVE + CANCELLED),
    "holdings": Command("significant_holdings", "ident?", PAGE + KNOWN + EFFECTIVE + CANCELLED, "issuer"),
    "treasury-positions": Command("treasury_stock_positions", "ident?", PAGE + KNOWN + EFFECTIVE + CANCELLED, "issuer"),
    "treasury-operations": Command("treasury_operations", "ident?", PAGE + KNOWN + EFFECTIVE + CANCELLED, "issuer"),
    "state": Command("state_for_issuer", "issuer_id", KNOWN),
    "feed": Command("feed", None, PAGE + ("issuer", "item_type", "include_backfill")),
    "feed-cursor-latest": Command("feed_cursor_latest", None, ("issuer", "item_type", "include_backfill")),
}


def instant(text: str) -> datetime:
    """ISO 8601; without an offset it is UTC."""
    at = datetime.fromisoformat(text.removesuffix("Z") + ("+00:00" if text.endswith("Z") else ""))
    return at if at.utcoffset() is not None else at.replace(tzinfo=timezone.utc)


def _flags() -> argparse.ArgumentParser:
    """Flags that may stand on either side of the command: none has a default, so that neither side hides the other."""
    p = argparse.ArgumentParser(add_help=False, argument_default=argparse.SUPPRESS)
    p.add_argument("--data", help="folder of the dataset, ./data unless told")
    p.add_argument("--format", choices=sorted(WRITERS))
    p.add_argument("--limit", type=int)
    p.add_argument("--cursor")
    p.add_argument("--known-at", type=instant, help="what had been observed by this instant")
    p.add_argument("--effective-at", type=date.fromisoformat, help="what had taken effect by this day")
    p.add_argument("--include-cancelled", action="store_true")
    return p


def parser() -> argparse.ArgumentParser:
    shared = _flags()
    p = argparse.ArgumentParser("chronofold", parents=[shared], description=__doc__.splitlines()[0])
    p.add_argument("--version", action="version", version=f"chronofold {__version__}, schema {SCHEMA_VERSION}")
    sub = p.add_subparsers(dest="command", required=True)
    for name, c in READ.items():
        s = sub.add_parser(name, parents=[shared], argument_default=argparse.SUPPRESS)
        if c.takes:
            s.add_argument("argument", metavar=c.takes.rstrip("?"), **({"nargs": "?"} if c.takes.endswith("?") else {}))
        if "item_type" in c.flags:
            s.add_argument("--issuer")
            s.add_argument("--type", dest="item_type")
            s.add_argument("--include-backfill", action="store_true")
        if name == "feed":
            s.add_argument("--from-latest", action="store_true", help="behind all that is known now")
    admin = sub.add_parser("admin", parents=[shared], help="jobs that write").add_subparsers(dest="job", required=True)
    for name, flags in jobs.ADMIN.items():
        s = admin.add_parser(name, parents=[shared], help=flags.__doc__.splitlines()[0])
        for flag, kind in jobs.options(flags).items():
            s.add_argument(f"--{flag.replace('_', '-')}", required=kind[1], type=instant if kind[0] is datetime else str)
    return p


def answer(ledger: Ledger, name: str, told: dict):
    c = READ[name]
    given = {k: told[k] for k in c.flags if k in told}
    if told.get("from_latest"):
        given["cursor"] = ledger.feed_cursor_latest(**{k: v for k, v in given.items() if k in READ["feed-cursor-latest"].flags})
    if c.into:
        given[c.into] = told.get("argument")
    return getattr(ledger, c.method)(*([told["argument"]] if c.takes and not c.into else []), **given)


def emit(result, fmt: str, out=None, err=None) -> None:
    payload, notes = WRITERS[fmt](result)
    for line in payload:
        print(line, file=out or sys.stdout)
    for note in notes:
        print(note, file=err or sys.stderr)


def session():
    from pyspark.sql import SparkSession

    return SparkSession.builder.appName("chronofold").config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()


def main(argv: list[str] | None = None, spark=None) -> int:
    try:
        told = vars(parser().parse_args(argv))
    except SystemExit as stop:
        return int(stop.code or 0)
    data = told.get("data", "data")
    try:
        if told["command"] == "admin":
            job = jobs.ADMIN[told["job"]]
            result = job(spark or session(), data, **{k: told[k] for k in jobs.options(job) if told.get(k) is not None})
        else:
            result = answer(Ledger.open(spark or session(), data), told["command"], told)
        emit(result, told.get("format", "table"))
    except LedgerError as refused:
        print(f"{type(refused).__name__}: {refused}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
