"""Read-only facade: bitemporal lists with keyset pages, the feed, annulment and provenance."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schema as S
from .cursors import Bookmarks, check_limit
from .errors import AmbiguousAnnulment, AmbiguousIdentifier, InvalidTemporalQuery, NotFound, UnsupportedQuery
from .functions.scalars import feed_item_id
from .operators import coverage as C
from .operators import documents as DOC
from .operators import feed as FD
from .operators import observations as O
from .operators import paging as P
from .operators import relations as R
from .operators import sequences as Q
from .runtime import materialize
from .sources.dataset import Dataset
from .sources.universe import identifiers

SCHEMA_VERSION = "1"


@dataclass(frozen=True)
class QueryResult:
    status: str
    items: tuple
    has_more: bool
    next_cursor: str | None
    history_mode: str | None = None
    known_at: datetime | None = None
    effective_at: date | None = None
    dataset_version: str | None = None
    watermark: datetime | None = None
    query: str | None = None

    @property
    def count(self) -> int:
        return len(self.items)

    def to_dict(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "items"} | {"count": self.count, "items": list(self.items), "schema_version": SCHEMA_VERSION}


@dataclass(frozen=True)
class Issuer:
    issuer_id: str
    identifiers: tuple = ()
    _ledger: object = field(default=None, repr=False, compare=False)

    def __getattr__(self, name):
        if name in ("notices", "events", "insider_transactions", "significant_holdings", "treasury_stock_positions", "treasury_operations", "feed"):
            return lambda **kw: getattr(self._ledger, name)(issuer=self, **kw)
        raise AttributeError(name)

    def to_dict(self) -> dict:
        return {"issuer_id": self.issuer_id, "identifiers": list(self.identifiers)}


class Ledger:
    """All methods read; each list is one plan with its filters inside, and at most limit + 1 rows reach the driver."""

    def __init__(self, spark: SparkSession, path: str, universe: DataFrame | None = None):
        self.spark, self.data, self.universe = spark, Dataset.open(spark, path), universe
        self._earliest: datetime | None = None
        self._feed: DataFrame | None = None
        self._parses: bool | None = None

    open = classmethod(lambda cls, spark, path, universe=None: cls(spark, path, universe))

    def _t(self, name: str) -> DataFrame:
        return self.data.table(name)

    def _relations(self) -> DataFrame:
        return R.clean_relations(self._t("notice_relation"))

    @property
    def dataset_version(self) -> str | None:
        r = self._t("crawl_run").agg(F.max_by("universe_version", "started_at")).first()
        return r[0] if r else None

    # -- issuers

    def company(self, ident: str) -> Issuer:
        """Exact resolution: none is NotFound, several are AmbiguousIdentifier."""
        if self.universe is None:
            raise NotFound(f"no universe to resolve {ident!r} in")
        ids = identifiers(self.universe, self._t("issuer"), self._t("issuer_alias"))
        hits = [r[0] for r in ids.where(F.col("ident") == ident.strip()).select("issuer_id").distinct().orderBy("issuer_id").limit(20).collect()]
        if not hits:
            raise NotFound(f"no issuer {ident!r}")
        if len(hits) > 1:
            raise AmbiguousIdentifier(f"{ident!r} may be {hits}")
        known = tuple(r[0] for r in ids.where(F.col("issuer_id") == hits[0]).select("ident").orderBy("ident").collect())
        return Issuer(hits[0], known, self)

    def _issuer(self, issuer) -> str | None:
        if issuer is None or isinstance(issuer, Issuer):
            return issuer and issuer.issuer_id
        try:
            return self.company(issuer).issuer_id
        except NotFound:
            for name in ("notice", "ledger_event"):
                if not self._t(name).where(F.col("issuer_id") == issuer).limit(1).isEmpty():
                    return issuer
            raise

    # -- temporal guards

    def _mode(self, known_at: datetime | None) -> str:
        if known_at is None:
            return S.CURRENT_KNOWLEDGE
        if not isinstance(known_at, datetime):
            raise InvalidTemporalQuery("known_at is an instant")
        if self._earliest is None:
            self._earliest = self._t("notice_observation").agg(F.unix_micros(F.min("observed_at"))).first()[0]
        return S.NO_HISTORY if self._earliest is not None and self._micros(known_at) < self._earliest else S.AS_KNOWN_AT

    @staticmethod
    def _micros(at: datetime) -> int:
        at = at if at.tzinfo else at.replace(tzinfo=timezone.utc)
        return round(at.timestamp() * 1_000_000)

    def _instant(self, at: datetime):
        return F.timestamp_micros(F.lit(self._micros(at)))

    def _known(self, df: DataFrame, known_at: datetime | None, key: str = "notice_key") -> DataFrame:
        if known_at is None:
            return df
        seen = self._t("notice_observation").where(F.col("observed_at") <= self._instant(known_at)).select(F.col("notice_key").alias(key)).distinct()
        return df.join(seen, key, "left_semi")

    def _uncancelled(self, df: DataFrame, known_at: datetime | None, include: bool) -> DataFrame:
        if include:
            return df
        return df.join(O.cancelled_as_of(self._t("notice_observation"), self._relations(), self._instant(known_at) if known_at else None), "notice_key", "left_anti")

    def _page(self, method: str, df: DataFrame, order: str, limit: int, cursor: str | None, filters: tuple, known_at=None, effective_at=None) -> QueryResult:
        check_limit(limit)
        mode, dv, keys = self._mode(known_at), self.dataset_version, P.ORDERS[order]
        marks = Bookmarks(method, tuple(df.schema[k.column].dataType.typeName() for k in keys), (*filters, known_at, effective_at), dv)
        behind = marks.read(cursor)[0] if cursor is not None else None
        told = dict(history_mode=mode, known_at=known_at, effective_at=effective_at, dataset_version=dv, query=method)
        if mode == S.NO_HISTORY:
            return QueryResult(S.NO_HISTORY, (), False, None, **told)
        rows = P.page(df, keys, limit, behind).collect()
        more, rows = len(rows) > limit, rows[:limit]
        nxt = marks.write([rows[-1][k.column] for k in keys]) if more else None
        return QueryResult("OK", tuple(r.asDict(True) for r in rows), more, nxt, **told)

    # -- lists

    def notice(self, key: str) -> dict:
        n = self._t("notice").where(F.col("notice_key") == key).distinct().limit(1).collect()
        if not n:
            raise NotFound(f"no notice {key!r}")
        first = O.first_observed(self._t("notice_observation").where(F.col("notice_key") == key)).collect()
        return n[0].asDict() | {"first_observed_at": first[0][1] if first else None}

    def notices(self, issuer=None, surface: str | None = None, known_at: datetime | None = None, limit: int = 200, cursor: str | None = None) -> QueryResult:
        iid = self._issuer(issuer)
        if surface is not None and surface not in S.SURFACES:
            raise UnsupportedQuery(f"surface {surface!r}")
        df = self._t("notice")
        if iid:
            df = df.where(F.col("issuer_id") == iid)
        if surface:
            df = df.where(F.col("source_surface") == surface)
        return self._page("notices", self._known(df.distinct(), known_at), "notices", limit, cursor, (iid, surface), known_at)

    def events(self, issuer=None, known_at: datetime | None = None, effective_at: date | None = None, basis: str | None = None, limit: int = 200, cursor: str | None = None) -> QueryResult:
        iid = self._issuer(issuer)
        if basis is not None and basis not in (S.SOURCE_DECLARED, S.DERIVED):
            raise UnsupportedQuery(f"basis {basis!r}")
        df = self._t("ledger_event")
        for c, v in (("issuer_id", iid), ("event_basis", basis)):
            if v:
                df = df.where(F.col(c) == v)
        if known_at:
            df = df.where(F.col("first_observed_at") <= self._instant(known_at))
        if effective_at:
            df = df.where(F.col("effective_date") <= F.lit(effective_at))
        return self._page("events", df.distinct(), "events", limit, cursor, (iid, basis), known_at, effective_at)

    def _with_notice(self, df: DataFrame, surfaces: tuple[str, ...], iid: str | None) -> DataFrame:
        n = self._t("notice").where(F.col("source_surface").isin(*surfaces))
        if iid:
            n = n.where(F.col("issuer_id") == iid)
        return df.join(n.select("notice_key", "issuer_id", "filing_date").dropDuplicates(["notice_key"]), "notice_key")

    # Where documents have been parsed the lists come from their last parse, parsed notices only; else from the stubs of the listings and from facts.

    def _has_parses(self) -> bool:
        if self._parses is None:
            self._parses = not self._t("notice_doc").where("parse_id is not null").limit(1).isEmpty()
        return self._parses

    def _current(self, name: str) -> DataFrame:
        return DOC.current_rows(self._t(name), self._t("notice_doc"))

    def _parsed(self, name: str, surfaces: tuple[str, ...], iid: str | None) -> DataFrame:
        return self._with_notice(self._current(name).where(F.col("parse_status").isin(*S.PARSED)), surfaces, iid)

    def _nested(self, page: QueryResult, key: str, children: dict[str, tuple[str, tuple[str, ...]]]) -> QueryResult:
        """The page with the child rows of its items, by one query per child table: name -> (table, order)."""
        asked = [i[key] for i in page.items]
        if not asked:
            return page
        found: dict[str, dict] = {}
        for name, (t, order) in children.items():
            of = found.setdefault(name, {})
            for r in self._current(t).where(F.col(key).isin(asked)).drop("parse_id").orderBy(*order).collect():
                of.setdefault(r[key], []).append({k: v for k, v in r.asDict().items() if k not in ("notice_key", "event_id")})
        return replace(page, items=tuple(i | {name: found[name].get(i[key], []) for name in children} for i in page.items))

    def insider_transactions(self, issuer=None, known_at=None, effective_at=None, include_cancelled: bool = False, limit: int = 200, cursor=None) -> QueryResult:
        iid = self._issuer(issuer)
        if self._has_parses():
            head = self._parsed("nod_notice_semantic", ("nod",), iid).select("notice_key", "issuer_id", "filing_date", "notification_kind", "notifying_party_name_raw", "notifying_party_kind", "closely_associated", "related_pdmr_name_raw", "related_pdmr_position_raw", "regulatory_template")
            df, on = self._current("transaction_event").drop("parse_id").join(head, "notice_key"), "transaction_date"
        else:
            df, on = self._with_notice(self._t("notice_event").distinct(), ("nod",), iid).withColumn("event_id", F.format_string("%s:%02d", "notice_key", "event_index")), "event_date"
        if effective_at:
            df = df.where(F.col(on) <= F.lit(effective_at))
        df = self._uncancelled(self._known(df, known_at), known_at, include_cancelled)
        page = self._page("insider_transactions", df, "insider_transactions", limit, cursor, (iid, include_cancelled), known_at, effective_at)
        return self._nested(page, "event_id", {"executions": ("execution_line", ("event_id", "line_index"))}) if self._has_parses() else page

    recent_insider_transactions = insider_transactions

    def _facts(self, kinds: tuple[str, ...], surfaces: tuple[str, ...], iid, name: str) -> DataFrame:
        f = self._t("source_fact").where(F.col("fact_type").isin(*kinds)).select("fact_id", "notice_key", "fact_type", F.col("effective_date").alias(name), "source_payload_json").dropDuplicates(["fact_id"])
        return self._with_notice(f, surfaces, iid)

    def significant_holdings(self, issuer=None, known_at=None, effective_at=None, include_cancelled: bool = False, limit: int = 200, cursor=None) -> QueryResult:
        iid = self._issuer(issuer)
        if self._has_parses():
            df = self._parsed("ps_notice_semantic", ("ps",), iid).drop("parse_id")
        else:
            df = self._facts(("PS_POSITION", "SIGNIFICANT_HOLDING_DISCLOSURE"), ("ps",), iid, "threshold_date")
            # one disclosure a notice, the position declared in it
            df = df.groupBy("notice_key", "issuer_id", "filing_date").agg(F.max("threshold_date").alias("threshold_date"), F.array_sort(F.collect_list(F.struct("fact_id", "source_payload_json"))).alias("positions"))
        if effective_at:
            df = df.where(F.col("threshold_date") <= F.lit(effective_at))
        df = self._uncancelled(self._known(df, known_at), known_at, include_cancelled)
        page = self._page("significant_holdings", df, "significant_holdings", limit, cursor, (iid, include_cancelled), known_at, effective_at)
        if not self._has_parses():
            return page
        rows = {"shares": "ps_shares_row", "instruments": "ps_instrument_row", "control_chain": "ps_control_chain_row", "loyalty": "ps_loyalty_row"}
        return self._nested(page, "notice_key", {n: (t, ("notice_key", *(("chain_path_index",) if n == "control_chain" else ()), "row_index")) for n, t in rows.items()})

    def treasury_stock_positions(self, issuer=None, known_at=None, effective_at=None, include_cancelled: bool = False, limit: int = 200, cursor=None) -> QueryResult:
        iid = self._issuer(issuer)
        if self._has_parses():
            df = self._parsed("ac_notice_semantic", ("ac",), iid).where("final_position_json is not null").drop("parse_id")
        else:
            df = self._facts(("TREASURY_POSITION", "TREASURY_RESULTING_POSITION"), ("ac",), iid, "notification_date")
            df = df.groupBy("notice_key", "issuer_id", "filing_date").agg(F.max_by(F.struct("notification_date", "fact_id", "source_payload_json"), F.struct(F.coalesce("notification_date", F.lit("0001-01-01").cast("date")), "fact_id")).alias("_p")).select("notice_key", "issuer_id", "filing_date", "_p.*")
        if effective_at:
            df = df.where(F.col("notification_date") <= F.lit(effective_at))
        df = self._uncancelled(self._known(df, known_at), known_at, include_cancelled)
        page = self._page("treasury_stock_positions", df, "treasury_stock_positions", limit, cursor, (iid, include_cancelled), known_at, effective_at)
        if not self._has_parses():
            return page
        return replace(page, items=tuple({k: v for k, v in i.items() if k != "final_position_json"} | {"final_position": json.loads(i["final_position_json"])} for i in page.items))

    def treasury_operations(self, issuer=None, known_at=None, effective_at=None, include_cancelled: bool = False, limit: int = 200, cursor=None) -> QueryResult:
        iid = self._issuer(issuer)
        if self._has_parses():
            head = self._parsed("ac_notice_semantic", ("ac",), iid).select("notice_key", "issuer_id", "filing_date", "issuer_name_document", "regulatory_template")
            df = self._current("ac_operation").drop("parse_id").join(head, "notice_key")
        else:
            df = self._with_notice(self._t("notice_event").distinct(), ("ac",), iid).withColumnsRenamed({"event_date": "operation_date", "event_index": "row_index"})
        if effective_at:
            df = df.where(F.col("operation_date") <= F.lit(effective_at))
        df = self._uncancelled(self._known(df, known_at), known_at, include_cancelled)
        return self._page("treasury_operations", df, "treasury_operations", limit, cursor, (iid, include_cancelled), known_at, effective_at)

    # -- the ledger of one issuer

    def events_for_issuer(self, issuer_id: str, mode: str = S.CURRENT_KNOWLEDGE, effective_at: date | None = None, known_at: datetime | None = None) -> DataFrame:
        """Events of an issuer in order of effect. AS_KNOWN_AT needs known_at; an instant before all observations gives none."""
        if mode not in (S.CURRENT_KNOWLEDGE, S.AS_KNOWN_AT):
            raise InvalidTemporalQuery(f"mode {mode!r}")
        if mode == S.AS_KNOWN_AT and known_at is None:
            raise InvalidTemporalQuery("AS_KNOWN_AT asks for known_at")
        df = self._t("ledger_event").where(F.col("issuer_id") == issuer_id)
        if effective_at:
            df = df.where(F.col("effective_date") <= F.lit(effective_at))
        if mode == S.AS_KNOWN_AT:
            df = df.where(F.col("first_observed_at") <= self._instant(known_at))
        return df.distinct().orderBy("effective_date", "event_id")

    def facts_for_issuer(self, issuer_id: str, effective_at: date | None = None, known_at: datetime | None = None) -> DataFrame:
        """Facts of an issuer's notices in order of effect."""
        mine = self._t("notice").where(F.col("issuer_id") == issuer_id).select("notice_key").distinct()
        df = self._t("source_fact").join(mine, "notice_key", "left_semi")
        if effective_at:
            df = df.where(F.col("effective_date") <= F.lit(effective_at))
        if known_at:
            df = df.where(F.col("first_observed_at") <= self._instant(known_at))
        return df.dropDuplicates(["fact_id"]).orderBy("effective_date", "fact_id")

    def state_for_issuer(self, issuer_id: str, known_at: datetime | None = None) -> dict:
        """Derived projection, never source truth: latest disclosure per subject, latest treasury position, insider events, and what can't be resolved.

        A notice counts as cancelled if its annulment leads to one terminal and, with known_at, an annulling notice was observed by then.
        """
        instant = self._instant(known_at) if known_at else None
        facts = self.facts_for_issuer(issuer_id, known_at=known_at)
        status = self._t("annulment_status") if self.data._exists("annulment_status") else R.annulment_status(self._edges())
        status = materialize(status.join(self._t("notice").where(F.col("issuer_id") == issuer_id).select("notice_key").distinct(), "notice_key", "left_semi"), "issuer-annulments")
        gone = R.resolved_cancellations(status, self._edges(), O.first_observed(self._t("notice_observation"), present_first=True), instant)
        left = facts.join(gone, "notice_key", "left_anti")
        g = lambda p: F.get_json_object("source_payload_json", p)
        order = [F.coalesce("effective_date", F.lit("0001-01-01").cast("date")), F.col("fact_id")]
        ps = left.where(F.col("fact_type").isin("SIGNIFICANT_HOLDING_DISCLOSURE", "PS_POSITION")).withColumn("subject", g("$.obliged_subject_name_raw")).withColumn("_k", F.coalesce("subject", "notice_key")).withColumn("position_current", g("$.position_current"))
        ps = Q.latest_per(ps, ["_k"], order, ["subject", "fact_id", "notice_key", "effective_date", "filing_date", "position_current"]).drop("_k").withColumn("identity_quality", F.when(F.col("subject").isNotNull(), "ISSUER_SCOPED_RAW_NAME").otherwise("UNRESOLVED"))
        ac = left.where(F.col("fact_type").isin("TREASURY_RESULTING_POSITION", "TREASURY_POSITION")).withColumn("final_position", g("$.final_position_json")).withColumn("_k", F.lit(1))
        ac = Q.latest_per(ac, ["_k"], order, ["fact_id", "notice_key", "effective_date", "filing_date", "final_position"]).drop("_k").collect()
        insiders = self.events_for_issuer(issuer_id, S.AS_KNOWN_AT if known_at else S.CURRENT_KNOWLEDGE, known_at=known_at).where(F.col("event_type").startswith("INSIDER_"))
        dicts = lambda df: [r.asDict(True) for r in df.collect()]  # noqa: E731 - one issuer's rows
        return {
            "issuer_id": issuer_id, "known_at": known_at, "significant_holdings": dicts(ps.orderBy(F.coalesce("subject", F.lit("")), "fact_id")), "treasury_position": ac[0].asDict(True) if ac else None,
            "reported_insider_events": dicts(insiders), "relation_errors": dicts(status.where("relation_status <> 'RESOLVED'").select("notice_key", "relation_status").orderBy("notice_key")), "projection": "DERIVED_NOT_SOURCE_TRUTH",
        }

    # -- annulment and provenance

    def _edges(self) -> DataFrame:
        return self._relations().where("relation_type = 'ANNULS'").select(F.col("annulling_key").alias("parent"), F.col("annulled_key").alias("child"))

    def annulment_status(self, key: str) -> dict:
        """Status of one notice: only its own chain is read, unless it is longer than some steps or the whole solution is stored."""
        return self._status([key])[key]

    def _status(self, keys: list[str]) -> dict[str, dict]:
        none = lambda k: {"notice_key": k, "relation_status": "NONE", "terminal": None, "annulling_notices": []}
        if self.data._exists("annulment_status"):
            found = {r["notice_key"]: r.asDict() for r in self._t("annulment_status").where(F.col("notice_key").isin(keys)).collect()}
        else:
            found = R.status_of(self._edges(), keys)
        return {k: found.get(k) or none(k) for k in keys}

    def current_authoritative(self, key: str) -> dict:
        st = self.annulment_status(key)
        kind = {"NONE": "AUTHORITATIVE", "RESOLVED": "SUPERSEDED"}.get(st["relation_status"], st["relation_status"])
        return {"notice_key": key, "status": kind, "authoritative": key if kind == "AUTHORITATIVE" else st["terminal"], "annulling_notices": st["annulling_notices"]}

    def require_authoritative(self, key: str) -> str:
        st = self.current_authoritative(key)
        if st["authoritative"] is None:
            raise AmbiguousAnnulment(f"{key}: {st['status']}")
        return st["authoritative"]

    def notice_record(self, key: str) -> dict:
        """A notice with its annulment and what is authoritative in its place."""
        return {"notice": self.notice(key), "annulment": self.annulment_status(key), "authoritative": self.current_authoritative(key)}

    def provenance_of(self, key: str) -> dict:
        """Provenance of an event, or of all events of a notice."""
        if not self._t("ledger_event").where(F.col("event_id") == key).limit(1).isEmpty():
            return self.provenance(key)
        rows = R.provenance(self._t("ledger_event").where(F.col("source_notice_key") == key), self._t("source_fact"), self._t("notice"), self._t("notice_observation")).orderBy("event_id").collect()
        if not rows:
            raise NotFound(f"no event of {key!r}")
        return {"notice_key": key, "events": [r.asDict() for r in rows]}

    def provenance(self, event_id: str) -> dict:
        r = R.provenance(self._t("ledger_event").where(F.col("event_id") == event_id), self._t("source_fact"), self._t("notice"), self._t("notice_observation")).collect()
        if not r:
            raise NotFound(f"no event {event_id!r}")
        return r[0].asDict()

    # -- dataset

    def dataset_info(self) -> dict:
        return C.dataset_info(self._t("notice"), self._t("notice_observation"), self._t("source_fact"), self._t("ledger_event"), self._t("crawl_run")).first().asDict() | {"schema_version": SCHEMA_VERSION, "dataset_version": self.dataset_version}

    def coverage(self) -> DataFrame:
        return C.coverage_matrix(self._t("notice").distinct())

    def coverage_record(self) -> dict:
        return {"coverage": [r.asDict(True) for r in self.coverage().orderBy("source_surface").collect()]}

    # -- feed

    def feed_items(self) -> DataFrame:
        if self._feed is None:
            stored = self.data._exists("feed_item")
            self._feed = self._t("feed_item") if stored else FD.build_feed(self._t("source_fact"), self._t("ledger_event"), self._t("notice"), self._t("notice_observation"), self._relations(), self._t("crawl_run"))
        return self._feed

    @staticmethod
    def _marks(issuer, item_type, include_backfill, dataset) -> Bookmarks:
        return Bookmarks("feed", ("long", "string"), (issuer, item_type, include_backfill), dataset, until=True)

    def feed(self, cursor=None, limit: int = 100, issuer=None, item_type: str | None = None, include_backfill: bool = False) -> QueryResult:
        """Items in the order they became known. The first page fixes a watermark that bounds the whole traversal."""
        check_limit(limit)
        iid = self._issuer(issuer)
        if item_type is not None and item_type not in S.FEED_TYPES:
            raise UnsupportedQuery(f"feed item type {item_type!r}; there are {S.FEED_TYPES}")
        dv = self.dataset_version
        marks = self._marks(iid, item_type, include_backfill, dv)
        scope = FD.select_feed(self.feed_items(), issuer=iid, item_type=item_type, include_backfill=include_backfill).where("observed_at is not null")
        key = mark = None
        if cursor is None:
            mark = scope.agg(F.unix_micros(F.max("observed_at"))).first()[0]
        else:
            key, mark = marks.read(cursor)
        if mark is not None:
            scope = scope.where(F.col("observed_at") <= F.timestamp_micros(F.lit(mark)))
        if key is not None:
            scope = scope.where(F.col("observed_at") >= F.timestamp_micros(F.lit(key[0])))
        scope = scope.withColumn("_us", F.unix_micros("observed_at"))
        # what a page shows besides the stored columns is computed for its rows only
        top = P.page(scope, (P.Key("_us"), P.Key("item_key")), limit, key)
        rows = top.withColumn("feed_item_id", feed_item_id("item_key")).withColumn("summary", FD.summary(F.col("feed_item_type"), F.col("payload_json"))).collect()
        rows.sort(key=lambda r: (r["_us"], r["item_key"]))
        more, rows = len(rows) > limit, rows[:limit]
        nxt = marks.write([rows[-1]["_us"], rows[-1]["item_key"]], mark) if more else None
        at = None if mark is None else datetime.fromtimestamp(mark / 1e6, timezone.utc)
        return QueryResult("OK", tuple(self._enrich([r.asDict() for r in rows])), more, nxt, dataset_version=dv, watermark=at, query="feed")

    def _enrich(self, items: list[dict]) -> list[dict]:
        """Annulment status of the page's cancellations, by one query for all of them."""
        relation = "CANCELLATION_RELATION_OBSERVED"
        cleaned = {i["annulled_key"]: i["annulled_key"].strip(" ").lower() for i in items if i["feed_item_type"] == relation}
        status = self._status(sorted(set(cleaned.values()))) if cleaned else {}
        for i in items:
            i.pop("_us", None)
            st = status.get(cleaned.get(i.get("annulled_key"))) if i["feed_item_type"] == relation else None
            i["annulment_status"] = st["relation_status"] if st else None
            if st:
                i["summary"] = json.dumps({"annulment_status": st["relation_status"], "annulling_notices": st["annulling_notices"]})
        return items

    def feed_cursor_latest(self, issuer=None, item_type: str | None = None, include_backfill: bool = False) -> str:
        """'From now' of a filtered feed: behind all that is known, without a watermark."""
        iid = self._issuer(issuer)
        scope = FD.select_feed(self.feed_items(), issuer=iid, item_type=item_type, include_backfill=include_backfill)
        top = scope.agg(F.unix_micros(F.max("observed_at"))).first()[0]
        return self._marks(iid, item_type, include_backfill, self.dataset_version).write([top if top is not None else -(1 << 62), "\U0010ffff"])
