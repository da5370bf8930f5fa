"""The landing run: object dumps (A4) -> raw rows (L1-L12) -> keyed merges into the raw tables (A8), with sync state.

Dumps are folders of JSON lines under one root, by object kind. Contacts,
deals and engagements are read from the last run's start on (A5); owners,
forms and submissions always in full. Each raw table is stored by key; an
object's rows carry its modified time, so that an older version that comes
later changes nothing. The streaming front lands its micro-batches with the
same functions.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partnerlens.operators.merge import SEQ, merge_into, read_keyed, staged
from partnerlens.session import let_go
from partnerlens.sources import landing as L
from partnerlens.sources.tables import RAW_KEYS

Objects = Callable[[str], DataFrame]  # the objects of a kind

# State names and the raw tables that each one's objects feed.
INCREMENTAL = {"contact": ("contact",), "deal": ("deal", "deal_stage_history", "deal_contact"), "engagement": ("engagement", "engagement_contact")}
STATE_KEYS = ["object_name"]


def land(table: str, objects: Objects, at: dt.datetime, once: bool = False) -> DataFrame:
    """The rows of one raw table from a batch of objects, each object as it was updated last; ``once``: the batch holds each once."""
    latest = objects if once else lambda kind: L.latest_objects(L.known(objects(kind), kind))
    if table == "owner":
        return L.land_owners(objects("owners"))
    if table == "contact":
        contacts = latest("contacts")
        return L.land_contacts(contacts, at, L.version(contacts, at))
    if table in ("deal", "deal_stage_history", "deal_contact"):
        deals = latest("deals")
        seq = L.version(deals, at)
        if table == "deal":
            return L.land_deals(deals, at, seq)
        return L.land_stage_history(deals, seq, once=True) if table == "deal_stage_history" else L.land_deal_contacts(deals, seq)
    if table == "engagement":
        return L.land_engagements({kind: latest(kind) for kind in L.ENGAGEMENT_TYPES}, at, lambda objs: [L.version(objs, at)])
    if table == "engagement_contact":
        out = None
        for kind in L.ENGAGEMENT_TYPES:
            rows = L.land_engagement_contacts(latest(kind))
            out = rows if out is None else out.unionByName(rows)
        return out
    if table == "form":
        return L.land_forms(objects("forms"))
    if table == "contact_form":
        return L.land_submissions(objects("submissions"))
    raise ValueError(f"unknown raw table: {table}")


def last_sync(spark: SparkSession, out_root: str, name: str) -> dt.datetime | None:
    """When the last finished run of an object began; None before the first one."""
    state = read_keyed(spark, f"{out_root}/_sync_state")
    row = state.filter(F.col("object_name") == name).first() if state is not None else None
    return row["last_sync_at"] if row else None


# Tables whose keys :func:`land` gives once: a row for each object, or for each distinct entry of one object.
ONCE = ("contact", "deal", "deal_stage_history")
# Tables whose keys it may give several times, but not many: for each kind, or for each entry of one object.
FEW = ("deal_contact", "engagement", "engagement_contact")


def store(spark: SparkSession, root: str, table: str, rows: DataFrame, cheap: bool = False) -> DataFrame:
    """Merges rows of :func:`land` into one raw table under root and returns it as it stands; ``cheap``: they come from staged objects."""
    seq = F.col(SEQ) if SEQ in rows.columns else F.col("submitted_at") if table == "contact_form" else None
    return merge_into(spark, f"{root}/{table}", rows, RAW_KEYS[table], seq, once=table in ONCE, few=table in FEW, cheap=cheap)


def store_submissions(spark: SparkSession, root: str, rows: DataFrame | None) -> DataFrame | None:
    """Merges submissions whose contacts are looked up among the stored ones (L11); then those stored without a contact are looked up again."""
    contacts = read_keyed(spark, f"{root}/contact")
    if rows is not None:
        store(spark, root, "contact_form", rows if contacts is None else L.resolve_contacts(rows, contacts))
    stored = read_keyed(spark, f"{root}/contact_form")
    if stored is None or contacts is None:
        return stored
    found = L.resolve_contacts(stored.filter("contact_id is null"), contacts).filter("contact_id is not null")
    return store(spark, root, "contact_form", found)


@contextmanager
def latest_staged(spark: SparkSession, objects: Objects) -> Iterator[Objects]:
    """The objects of each kind as they were updated last, as a table in the shared folder, which is written when a kind is asked for first."""
    held: dict[str, tuple[DataFrame, Callable[[], None]]] = {}

    def staged_once(kind: str) -> DataFrame:
        if kind not in held:
            held[kind] = staged(spark, L.latest_objects(L.known(objects(kind), kind)))
            let_go(spark)
        return held[kind][0]

    try:
        yield staged_once
    finally:
        for _, drop in held.values():
            drop()


def landing_run(spark: SparkSession, dump_root: str, out_root: str, run_started: dt.datetime) -> dict[str, DataFrame]:
    """Lands all nine raw tables under out_root and returns them as they stand; run_started is when they were read.

    A kind whose folder is missing is skipped, with its state left as it was. The
    objects of a kind that feeds several tables are read and sorted out once.
    """
    tables: dict[str, DataFrame] = {}

    def put(table: str, objects: Objects, once: bool = False) -> None:
        rows = land(table, objects, run_started, once)
        tables[table] = store_submissions(spark, out_root, rows) if table == "contact_form" else store(spark, out_root, table, rows, cheap=once)
        del rows
        let_go(spark)  # shuffle files go before the next table is landed

    def dumped(since: dt.datetime | None = None) -> Objects:
        return lambda kind: L.objects_since(L.objects(spark, f"{dump_root}/{kind}", L.KINDS.get(kind, "object")), since)

    def step(name: str | None, names: tuple[str, ...]) -> None:
        try:
            since = last_sync(spark, out_root, name) if name else None
            objects, several = dumped(since), len(names) > 1
            with latest_staged(spark, objects) as latest:
                for table in names:
                    put(table, latest if several else objects, once=several)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return
        if name:
            merge_into(spark, f"{out_root}/_sync_state", L.sync_state(spark, name, run_started), STATE_KEYS, buckets=1)

    step(None, ("owner",))
    for name, names in INCREMENTAL.items():
        step(name, names)
    step(None, ("form",))
    step(None, ("contact_form",))
    return tables
