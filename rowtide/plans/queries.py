"""Query registry: name -> callable(spark, sf_dir) -> DataFrame (one per operator of the inventory)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.functions.packets import unknown_keys
from rowtide.operators.constraints import cascade_update, check_restrict, quarantine
from rowtide.operators.keys import profile_keys
from rowtide.operators.related import apply_related
from rowtide.operators.segmented import apply_key_moves, apply_log, apply_segmented
from rowtide.functions.packets import packets_delete, packets_update, packets_upsert
from rowtide.operators.align import prepare
from rowtide.operators.apply import apply_changes
from rowtide.session import materialize, scratch_path
from rowtide.sources.tables import read_snapshot
from rowtide.streaming.stream import stream_destination
from rowtide.sources.capture import capture_changes, capture_deletes, capture_diff, capture_inserts, capture_updates, route_changes
from rowtide.sources.packets import encode_packets, parse_packets, read_packets, write_packets
from rowtide.operators.distribute import accepted, apply_targets, fan_out
from rowtide.operators.stats import counter_deltas, recent, sample_stats, worker_stats
from rowtide.plans import fixtures as fx
from rowtide.plans.pipeline import run_destination

Query = Callable[[SparkSession, str], DataFrame]


def _accounts(spark: SparkSession, sf: str, actions: tuple[str, ...] | None = None):
    log = fx.accounts_log(spark, sf)
    if actions:
        log = log.where(F.col("action").isin(*actions))
    return apply_changes(fx.accounts_base(spark, sf), log, fx.ACCOUNTS)


def apply_mixed_log(spark: SparkSession, sf: str) -> DataFrame:
    """The whole events log (add/set/update/delete, unknown column, explicit NULLs) on accounts."""
    return _accounts(spark, sf).table


def packet_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """Per packet outcome and reason."""
    return _accounts(spark, sf).outcomes.select("seq", "action", "user_id", "outcome", "reason")


def apply_add(spark, sf):
    """A1: inserts only."""
    return _accounts(spark, sf, ("add",)).table


def apply_delete(spark, sf):
    """A2: deletes only."""
    return _accounts(spark, sf, ("delete",)).table


def apply_update(spark, sf):
    """A3: updates only."""
    return _accounts(spark, sf, ("update",)).table


def apply_set(spark, sf):
    """A4: upserts by primary key only."""
    return _accounts(spark, sf, ("set",)).table


def reject_duplicate(spark, sf):
    """Inserts refused because the key is live."""
    o = _accounts(spark, sf).outcomes
    return o.where(F.col("reason") == "duplicate_key").select("seq", "user_id")


def reject_not_null(spark, sf):
    """Inserts refused because a NOT NULL column without default is missing or NULL."""
    o = _accounts(spark, sf).outcomes
    return o.where(F.col("reason") == "not_null").select("seq", "action", "user_id")


def restrict_full_key(spark, sf):
    """update/delete restricted by the whole key: did the predicate hit a live row."""
    o = _accounts(spark, sf).outcomes
    return o.where(F.col("action").isin("update", "delete")).select(
        "seq", "action", "user_id", F.col("outcome").isin("updated", "deleted").alias("hit")
    )


def fill_defaults(spark, sf):
    """K5: rows as inserted, absent columns filled with their defaults."""
    r = _accounts(spark, sf)
    e = r.effects.where(F.col("outcome") == "inserted")
    return e.select(
        "seq", "user_id", F.col("d__value").alias("value"),
        F.when(F.col("dp__segment"), F.col("d__segment")).otherwise(fx.ACCOUNTS.default("segment")).alias("segment"),
    )


def _lines(spark, sf):
    # the base is an aggregate over lineitem, read by several branches: written once as a table
    return apply_changes(materialize(fx.lines_base(spark, sf)), fx.lines_log(spark, sf), fx.LINES)


def apply_partial_log(spark, sf):
    """Ordered log mixing full-key and partial-key packets on a composite key."""
    return _lines(spark, sf).table


def restrict_partial_key(spark, sf):
    """rows hit by packets that name only part of the composite key."""
    e = _lines(spark, sf).effects
    return e.where((F.col("match_kind") == "pk_partial") & F.col("outcome").isin("updated", "deleted")).select(
        "seq", "l_orderkey", "l_linenumber", "outcome"
    )


def apply_set_partial(spark, sf):
    """Partial-key sets update every live matching row; none -> rejected (the insert lacks the key)."""
    o = _lines(spark, sf).outcomes
    return o.where((F.col("action") == "set") & (F.col("match_kind") == "pk_partial")).select(
        "seq", "outcome", F.col("rows").cast("long").alias("rows")
    )


# ---------------------------------------------------------------- capture
def _order_images(spark, sf):
    return capture_diff(fx.snap_old(spark, sf), fx.snap_new(spark, sf), fx.ORDERS)


def _wire_fields(packets: DataFrame, contract, cols: list[str]) -> DataFrame:
    """Encode to JSON, decode again and read typed fields: checks the wire round trip."""
    p = prepare(parse_packets(encode_packets(packets)), contract)
    return p.select("seq", "action", *[F.col(f"r__{c}").alias(f"r_{c}") for c in contract.primary_key],
                    *[F.col(f"d__{c}").alias(c) for c in cols])


def capture_insert(spark, sf):
    """INSERT images -> add packets carrying the whole new row."""
    return _wire_fields(capture_inserts(_order_images(spark, sf), fx.ORDERS), fx.ORDERS, fx.ORDERS.names)


def capture_update(spark, sf):
    """UPDATE images -> update packets: restriction = old key, data = whole new row."""
    return _wire_fields(capture_updates(_order_images(spark, sf), fx.ORDERS), fx.ORDERS, fx.ORDERS.names)


def capture_delete(spark, sf):
    """DELETE images -> delete packets restricted by the old key."""
    return _wire_fields(capture_deletes(_order_images(spark, sf), fx.ORDERS), fx.ORDERS, [])


def capture_diff_apply(spark, sf):
    """C4: diff two snapshots, apply the captured packets to the old one -> equals the new one."""
    old = fx.snap_old(spark, sf)
    packets = capture_changes(_order_images(spark, sf), fx.ORDERS)
    return apply_changes(old, packets, fx.ORDERS).table


def route_changes_q(spark, sf):
    """Captured changes of two tables routed by the registry; the unregistered one is quarantined."""
    orders = _order_images(spark, sf).select(F.lit("public").alias("schema_name"), F.lit("orders").alias("table_name"), "seq", "op")
    cust = capture_diff(fx.customer_old(spark, sf), fx.customer_new(spark, sf), fx.CUSTOMERS).select(
        F.lit("public").alias("schema_name"), F.lit("customer").alias("table_name"), "seq", "op")
    routed = route_changes(orders.unionByName(cust), fx.capture_registry(spark))
    return routed.select("schema_name", "table_name", "seq", "op", "queue",
                         F.array_join("key_columns", ",").alias("key_columns"), "reason")


# ---------------------------------------------------------------- wire packets
def _json_prepared(spark, sf, strict=True):
    return prepare(parse_packets(fx.json_log(spark, sf)), fx.ACCOUNTS, strict)


def parse_packets_q(spark, sf):
    """JSON bodies -> envelope (malformed bodies decode to NULL fields)."""
    p = parse_packets(fx.json_log(spark, sf))
    return p.select(
        "pos", "seq", "action",
        F.col("data").getItem("value").try_cast("double").alias("value"),
        F.coalesce(F.map_contains_key("data", "segment"), F.lit(False)).alias("has_segment"),
        F.col("data").getItem("segment").alias("segment"),
        F.col("restriction").getItem("user_id").try_cast("bigint").alias("r_user_id"),
        F.size(F.map_keys("restriction")).alias("n_restriction"),
    )


def validate_packets_q(spark, sf):
    """P2 (+F5): reject reasons that need no table state."""
    return _json_prepared(spark, sf).select("pos", "seq", "match_kind", "reject_reason")


def align_columns_q(spark, sf):
    """Presence flags and values per contract column; unknown columns dropped."""
    return _json_prepared(spark, sf).where(F.col("action").isNotNull()).select(
        "pos", "dp__user_id", "dp__value", "dp__segment", "d__segment", "rp__user_id",
        F.size("unknown_data").alias("n_unknown_data"), F.size("unknown_restriction").alias("n_unknown_restriction"),
    )


def typed_values_q(spark, sf):
    """Values cast to the contract types; a failed cast is flagged, never fails the job."""
    return _json_prepared(spark, sf).where(F.col("action").isNotNull()).select("pos", "d__user_id", "d__value", "bad_value")


def encode_packets_q(spark, sf):
    """P5: packets -> JSON (explicit nulls kept) -> decoded again."""
    body = encode_packets(fx.accounts_log(spark, sf))
    back = F.from_json("body", "seq bigint, action string, data map<string,string>")
    return body.select(back.alias("p")).select(
        "p.seq", "p.action",
        F.coalesce(F.map_contains_key("p.data", "segment"), F.lit(False)).alias("has_segment"),
        F.col("p.data").getItem("segment").alias("segment"),
        F.col("p.data").getItem("value").try_cast("double").alias("value"),
    )


def read_packets_q(spark, sf):
    """JSON packet bodies written as text files, read back as a packet source."""
    path = scratch_path(spark, "packets")
    write_packets(fx.json_log(spark, sf), path)
    return read_packets(spark, path).select("seq", "action", F.col("action").isNull().alias("malformed"))


def packets_from_frame(spark, sf):
    """Client verbs (upsert / delete / update) built from customer rows, applied to accounts."""
    c = fx.table(spark, sf, "customer").select(
        F.col("c_custkey").cast("bigint").alias("user_id"), F.col("c_acctbal").alias("value"), F.col("c_mktsegment").alias("segment"))
    seq = F.col("user_id")
    up = packets_upsert(c.where(~F.col("segment").isin(fx.VERB_DELETE_SEGMENT, fx.VERB_UPDATE_SEGMENT)), seq)
    de = packets_delete(c.where(F.col("segment") == fx.VERB_DELETE_SEGMENT), seq, ["user_id"])
    upd = packets_update(c.where(F.col("segment") == fx.VERB_UPDATE_SEGMENT).withColumn("value", F.col("value") + 1), seq,
                         ["user_id"], ["value"])
    return apply_changes(fx.accounts_base(spark, sf), up.unionByName(de).unionByName(upd), fx.ACCOUNTS).table


# ---------------------------------------------------------------- distribution
def _accounts_pipeline(spark, sf, processor=apply_changes):
    return run_destination(
        fx.accounts_base(spark, sf), fx.accounts_log(spark, sf), fx.routes(spark), fx.ACCOUNTS, "accounts",
        fx.accounts_target_bases(spark, sf), processor=processor,
    )


def accepted_stream(spark, sf):
    """Forwarded packets: everything but rejected / quarantined (no-ops included)."""
    o = accepted(_accounts(spark, sf).outcomes)
    return o.select("seq", "action", "user_id", "outcome")


def fan_out_q(spark, sf):
    """Accepted packets of two destinations copied to each target queue (disabled targets too)."""
    r = fx.routes(spark)
    acc = fan_out(accepted(_accounts(spark, sf).outcomes), r, "accounts")
    lin = fan_out(accepted(_lines(spark, sf).outcomes), r, "lines")
    cols = ["destination", "target", "queue", "seq", "action"]
    return acc.select(*cols).unionByName(lin.select(*cols))


def routes_enabled(spark, sf):
    """D3: only enabled targets apply (replica_b of accounts is disabled)."""
    return _accounts_pipeline(spark, sf).targets.table.select("target", *fx.ACCOUNTS.names)


def apply_targets_q(spark, sf):
    """Every target applies the forwarded packets to its own replica, all in one fold."""
    dest = _accounts(spark, sf)
    fwd = fan_out(accepted(dest.outcomes).select("seq", "action", "data", "restriction"), fx.routes(spark), "accounts")
    return apply_targets(fx.accounts_target_bases(spark, sf), fwd, fx.ACCOUNTS).table.select("target", *fx.ACCOUNTS.names)


def pipeline_batch(spark, sf):
    """Destination + enabled replicas after one batch, tagged by worker."""
    p = _accounts_pipeline(spark, sf)
    d = p.destination.table.select(F.lit("accounts").alias("worker"), *fx.ACCOUNTS.names)
    t = p.targets.table.select(F.col("target").alias("worker"), *fx.ACCOUNTS.names)
    return d.unionByName(t)


def _soft_delete(base, packets, contract, **kw):
    """A user processor: deletes become an update marking the row, everything else as usual."""
    deleted = F.col("action") == "delete"
    p = packets.withColumn("data", F.when(deleted, F.create_map(F.lit("segment"), F.lit(fx.SOFT_DELETE_SEGMENT))).otherwise(F.col("data")))
    p = p.withColumn("action", F.when(deleted, F.lit("update")).otherwise(F.col("action")))
    return apply_changes(base, p, contract, **kw)


def custom_processor(spark, sf):
    """The destination runs a user-supplied processor instead of the default fold."""
    return _accounts_pipeline(spark, sf, processor=_soft_delete).destination.table


def target_tables(spark, sf):
    """A replica with the destination's table, one with one more column (filled from the whole forwarded packet), and
    one with a function of its own."""
    from rowtide.operators.distribute import ROUTES_DDL

    res = run_destination(
        fx.accounts_base(spark, sf), fx.accounts_log(spark, sf), spark.createDataFrame(fx.TARGET_ROUTES, ROUTES_DDL), fx.ACCOUNTS, "accounts",
        fx.stamped_target_bases(spark, sf), target_contracts={"replica_b": fx.STAMPED_ACCOUNTS}, target_processors={"replica_c": _soft_delete},
    )
    return res.targets.table.select("target", *fx.STAMPED_ACCOUNTS.names)


# ---------------------------------------------------------------- statistics
def worker_stats_q(spark, sf):
    """O1: counters per worker (destination + enabled targets)."""
    p = _accounts_pipeline(spark, sf)
    d = p.destination.outcomes.withColumn("worker", F.lit("accounts"))
    t = p.targets.outcomes.withColumn("worker", F.col("target"))
    cols = ["worker", "action", "outcome"]
    return worker_stats(d.select(*cols).unionByName(t.select(*cols)))


def _samples(spark, sf):
    o = _accounts(spark, sf).outcomes
    o = o.withColumn("worker", F.concat(F.lit("w"), (F.col("user_id") % fx.STATS_WORKERS).cast("string")))
    return sample_stats(o, fx.STATS_INTERVAL)


def sampled_counters(spark, sf):
    """Cumulative counters per worker at the end of each tumbling interval."""
    return _samples(spark, sf)


def counter_deltas_q(spark, sf):
    """O2: per-interval deltas; a worker's first sample gives none."""
    return counter_deltas(_samples(spark, sf))


def recent_samples(spark, sf):
    """O3: the last 300 delta points per worker."""
    return recent(counter_deltas(_samples(spark, sf)), 300)


# ---------------------------------------------------------------- keys
PROFILE_CANDIDATES = [("l_orderkey", "l_linenumber"), ("l_orderkey",), ("l_orderkey", "l_partkey", "l_suppkey")]


def profile_keys_q(spark, sf):
    """K1: prove candidate keys of lineitem on the data (one scan for all candidates)."""
    return profile_keys(fx.table(spark, sf, "lineitem"), PROFILE_CANDIDATES)


def resolve_key_q(spark, sf):
    """K2: which columns identify the rows of each packet: pk (pages by id, whole line keys), unique
    (pages by url), pk_partial (lines by order only), none (keyless documents)."""
    pages = prepare(fx.page_set(spark, sf), fx.PAGES).select(F.lit("pages").alias("log"), "seq", "match_kind")
    lines = prepare(fx.lines_log(spark, sf), fx.LINES).select(F.lit("lines").alias("log"), "seq", "match_kind")
    docs = prepare(fx.docs_add(spark, sf), fx.SURROGATES).select(F.lit("documents").alias("log"), "seq", "match_kind")
    return pages.unionByName(lines).unionByName(docs)


def apply_set_unique(spark, sf):
    """A5: sets matched by the unique url; unmatched urls insert new pages with allocated ids."""
    return apply_changes(fx.pages_base(spark, sf), fx.page_set(spark, sf), fx.PAGES).table


def _docs(spark, sf):
    return apply_changes(fx.surrogate_base(spark, sf), fx.docs_add(spark, sf), fx.SURROGATES)


def allocate_surrogate(spark, sf):
    """K3: keyless inserts get max(id) + rank in seq order (gapless, no one-partition window)."""
    return _docs(spark, sf).effects.select("seq", "note_id")


def enrich_returned_key(spark, sf):
    """K4: the allocated key travels in the forwarded packet so that replicas agree."""
    o = accepted(_docs(spark, sf).outcomes)
    return o.select("seq", F.col("data").getItem("note_id").cast("bigint").alias("note_id"))


def apply_set_insert(spark, sf):
    """Keyless add/set packets insert whole documents as new rows."""
    return _docs(spark, sf).table


# ---------------------------------------------------------------- constraints
def _labels(spark, sf):
    return apply_changes(fx.empty_like(spark, fx.LABELS), fx.label_add(spark, sf), fx.LABELS,
                         parents={"documents": fx.label_parents(spark, sf)})


def reject_fk(spark, sf):
    """Label inserts whose document is not in the parent table are rejected."""
    o = _labels(spark, sf).outcomes
    return o.where(F.col("reason") == "foreign_key").select("seq", "doc_id")


def restrict_parent_delete(spark, sf):
    """Deleting a document that still has a label is refused (ON DELETE RESTRICT)."""
    child = _labels(spark, sf).table
    d = fx.table(spark, sf, "documents")
    return check_restrict(d.select(F.col("doc_id").alias("seq"), "doc_id"), child, fx.LABELS.foreign_keys[0]).select("seq", "doc_id", "outcome")


def cascade_parent_key(spark, sf):
    """A document key change rewrites the labels that point at it (ON UPDATE CASCADE)."""
    child = _labels(spark, sf).table
    docs = fx.table(spark, sf, "documents")
    off = docs.agg((F.max("doc_id") + 1).alias("__off")).withColumn("__one", F.lit(1))
    # ``off`` is a one-row aggregate: a proven broadcast bound
    moves = docs.withColumn("__one", F.lit(1)).join(F.broadcast(off), "__one").select(
        F.col("doc_id").alias("old_doc_id"), (F.col("doc_id") + F.col("__off")).alias("new_doc_id"))
    return cascade_update(child, moves, fx.LABELS.foreign_keys[0])


def _related(spark, sf):
    parents, children = fx.related_logs(spark, sf)
    return apply_related(fx.documents_base(spark, sf), fx.empty_like(spark, fx.RELATED_LABELS), parents, children, fx.DOCUMENTS, fx.RELATED_LABELS, fx.RELATED_LABELS.foreign_keys[0])


def fk_two_tables(spark, sf):
    """Labels after one log with their documents: orphans rejected, deletes refused, new keys followed."""
    return _related(spark, sf).child.table


def fk_two_tables_outcomes(spark, sf):
    """The outcome of every packet of both tables."""
    res = _related(spark, sf)
    return res.parent.outcomes.select("seq", "action", "outcome", "reason").unionByName(res.child.outcomes.select("seq", "action", "outcome", "reason"))


def _json_apply(spark, sf, strict=True):
    pk = parse_packets(fx.json_log(spark, sf))
    pk = pk.withColumn("n_unknown_r", F.size(unknown_keys("restriction", fx.ACCOUNTS)))
    return apply_changes(fx.accounts_base(spark, sf), pk, fx.ACCOUNTS, strict_restrictions=strict)


def quarantine_q(spark, sf):
    """Packets that would halt the reference's worker are set aside with their reason."""
    return quarantine(_json_apply(spark, sf).outcomes).select("pos", "reason")


def restrict_unknown_col(spark, sf):
    """lenient mode drops unknown restriction columns (the predicate widens) and applies."""
    o = _json_apply(spark, sf, strict=False).outcomes
    return o.where(F.col("n_unknown_r") > 0).select("pos", "seq", "outcome")


# ---------------------------------------------------------------- slow tiers
def restrict_non_key(spark, sf):
    """F3 (+F6): update/delete restricted on an non-key column that no packet writes (c_nationkey)."""
    return apply_segmented(fx.customer_old(spark, sf), fx.barrier_log(spark, sf, "nation"), fx.CUSTOMERS).table


def apply_barriers(spark, sf):
    """Restrictions on a column the log itself rewrites (c_mktsegment): order matters."""
    return apply_segmented(fx.customer_old(spark, sf), fx.barrier_log(spark, sf, "segment"), fx.CUSTOMERS).table


def restrict_null(spark, sf):
    """a restriction to NULL hits nothing, not even NULLs."""
    o = apply_log(fx.customer_old(spark, sf), fx.named_customer_log(spark, sf), fx.NAMED_CUSTOMERS).outcomes
    return o.where(F.col("seq").between(2000, 9999)).select("seq", "outcome")


def unique_all_tiers(spark, sf):
    """A unique column written and freed by restrictions on other columns, and by whole rows, in one log."""
    return apply_log(fx.customer_old(spark, sf), fx.named_customer_log(spark, sf), fx.NAMED_CUSTOMERS).table


def unique_all_tiers_outcomes(spark, sf):
    """Which of these packets are refused or halt."""
    o = apply_log(fx.customer_old(spark, sf), fx.named_customer_log(spark, sf), fx.NAMED_CUSTOMERS).outcomes
    return o.select("seq", "action", "outcome", "reason", F.col("rows").cast("long").alias("rows"))


def key_move_partial(spark, sf):
    """A3, A10: updates that name a new key and nothing else; the row's values follow, later packets find it there."""
    return apply_log(fx.snap_old(spark, sf), fx.key_move_partial_log(spark, sf), fx.ORDERS).table


def _workers(res, name, contract):
    d = res.destination.table.select(F.lit(name).alias("worker"), *contract.names)
    return d.unionByName(res.targets.table.select(F.col("target").alias("worker"), *contract.names))


def pipeline_key_move(spark, sf):
    """Key moves at the destination and its replica."""
    from rowtide.operators.distribute import ROUTES_DDL

    old = fx.snap_old(spark, sf)
    res = run_destination(old, fx.key_move_partial_log(spark, sf), spark.createDataFrame(fx.ORDER_ROUTES, ROUTES_DDL), fx.ORDERS, "orders", old.withColumn("target", F.lit("replica_a")))
    return _workers(res, "orders", fx.ORDERS)


def pipeline_barriers(spark, sf):
    """Restrictions on a column that the log rewrites, at the destination and two replicas with different rows."""
    from rowtide.operators.distribute import ROUTES_DDL

    res = run_destination(fx.customer_old(spark, sf), fx.barrier_log(spark, sf, "segment"), spark.createDataFrame(fx.CUSTOMER_ROUTES, ROUTES_DDL), fx.CUSTOMERS, "customers", fx.customer_target_bases(spark, sf))
    return _workers(res, "customers", fx.CUSTOMERS)


def apply_key_move(spark, sf):
    """A10: whole-row updates that change the key (capture images)."""
    return apply_key_moves(fx.snap_old(spark, sf), fx.key_move_log(spark, sf), fx.ORDERS).table


def key_move_outcomes(spark, sf):
    """A10: one outcome per moving packet, also for those that hit nothing."""
    return apply_key_moves(fx.snap_old(spark, sf), fx.key_move_log(spark, sf), fx.ORDERS).outcomes.select("seq", "outcome")


def apply_unique_mixed(spark, sf):
    """Keyless adds, sets by url and changed urls in one log; owners as of each packet, ids over all new rows."""
    return apply_log(fx.pages_base(spark, sf), fx.unique_log(spark, sf), fx.PAGES).table


def reject_duplicate_unique(spark, sf):
    """An add whose unique value another row has."""
    o = apply_log(fx.pages_base(spark, sf), fx.unique_log(spark, sf), fx.PAGES).outcomes
    return o.where(F.col("reason") == "duplicate_unique").select("seq", "action")


def outcomes_complete(spark, sf):
    """Every packet of the log, malformed ones included, has exactly one outcome."""
    o = apply_log(fx.accounts_base(spark, sf), parse_packets(fx.json_log(spark, sf)), fx.ACCOUNTS).outcomes
    return o.groupBy("pos").agg(F.count(F.lit(1)).cast("int").alias("outcomes"))


# ---------------------------------------------------------------- streaming
STREAM_SLICES = 4


def _stream(spark, sf, slices, order, checkpoints=1):
    """The JSON log as files, one micro-batch run per slice, in the given order of slices; the last snapshot."""
    src, root = scratch_path(spark, "stream-src"), scratch_path(spark, "stream-table")
    ckpt = [(scratch_path(spark, "stream-ckpt"), f"{src}/{i}") for i in range(checkpoints)]
    log = fx.json_log(spark, sf)
    bounds = log.agg(F.min("pos").alias("lo"), F.max("pos").alias("hi")).first()
    lo, hi = bounds["lo"], bounds["hi"]
    step = (hi - lo) // slices + 1 if slices != 2 else (lo + hi) // 2 - lo
    base = fx.accounts_base(spark, sf)
    for n, i in enumerate(order):
        last = i == slices - 1
        part = log.where((F.col("pos") >= lo + i * step) & (F.lit(last) | (F.col("pos") < lo + (i + 1) * step)))
        folder, files = ckpt[n * checkpoints // len(order)]
        write_packets(part, files)
        stream_destination(spark, files, base, fx.ACCOUNTS, root, folder, max_files_per_trigger=None).awaitTermination()
    return read_snapshot(spark, root)


def pipeline_stream(spark, sf):
    """The JSON packet log arrives as files in seq order; each arrival is one micro-batch run
    (availableNow) of the same stream; the final snapshot equals the one-batch result."""
    return _stream(spark, sf, STREAM_SLICES, range(STREAM_SLICES))


def stream_late_packets(spark, sf):
    """The first half of the log arrives after the second; arrival order counts, nothing is dropped."""
    return _stream(spark, sf, 2, (1, 0))


def stream_restart(spark, sf):
    """A second stream with a new checkpoint goes on from the table's current version."""
    return _stream(spark, sf, 2, (0, 1), checkpoints=2)


def target_catch_up(spark, sf):
    """D3: a replica that is disabled for the first half of the log applies it from its queue once it is enabled."""
    from rowtide.operators.distribute import ROUTES_DDL

    src, root, ckpt = (scratch_path(spark, f"catch-up-{x}") for x in ("src", "table", "ckpt"))
    log = fx.json_log(spark, sf)
    bounds = log.agg(F.min("pos").alias("lo"), F.max("pos").alias("hi")).first()
    half = (bounds["lo"] + bounds["hi"]) // 2
    base, replicas = fx.accounts_base(spark, sf), fx.accounts_target_bases(spark, sf)
    for enabled, part in ((False, log.where(F.col("pos") < half)), (True, log.where(F.col("pos") >= half))):
        routes = spark.createDataFrame([("accounts", "replica_a", "a", "public.accounts", True), ("accounts", "replica_b", "b", "public.accounts", enabled)], ROUTES_DDL)
        write_packets(part, src)
        stream_destination(spark, src, base, fx.ACCOUNTS, root, ckpt, None, routes=routes, destination="accounts", target_bases=replicas).awaitTermination()
    return read_snapshot(spark, f"{root}/_targets")


def queries() -> dict[str, Query]:
    return {
        "apply_mixed_log": apply_mixed_log,
        "packet_outcomes": packet_outcomes,
        "apply_add": apply_add,
        "apply_delete": apply_delete,
        "apply_update": apply_update,
        "apply_set": apply_set,
        "reject_duplicate": reject_duplicate,
        "reject_not_null": reject_not_null,
        "restrict_full_key": restrict_full_key,
        "fill_defaults": fill_defaults,
        "apply_partial_log": apply_partial_log,
        "restrict_partial_key": restrict_partial_key,
        "apply_set_partial": apply_set_partial,
        "capture_insert": capture_insert,
        "capture_update": capture_update,
        "capture_delete": capture_delete,
        "capture_diff": capture_diff_apply,
        "route_changes": route_changes_q,
        "parse_packets": parse_packets_q,
        "validate_packets": validate_packets_q,
        "align_columns": align_columns_q,
        "typed_values": typed_values_q,
        "encode_packets": encode_packets_q,
        "read_packets": read_packets_q,
        "packets_from_frame": packets_from_frame,
        "accepted_stream": accepted_stream,
        "fan_out": fan_out_q,
        "routes_enabled": routes_enabled,
        "apply_targets": apply_targets_q,
        "pipeline_batch": pipeline_batch,
        "custom_processor": custom_processor,
        "target_tables": target_tables,
        "worker_stats": worker_stats_q,
        "sampled_counters": sampled_counters,
        "counter_deltas": counter_deltas_q,
        "recent_samples": recent_samples,
        "profile_keys": profile_keys_q,
        "resolve_key": resolve_key_q,
        "apply_set_unique": apply_set_unique,
        "allocate_surrogate": allocate_surrogate,
        "enrich_returned_key": enrich_returned_key,
        "apply_set_insert": apply_set_insert,
        "reject_fk": reject_fk,
        "restrict_parent_delete": restrict_parent_delete,
        "cascade_parent_key": cascade_parent_key,
        "fk_two_tables": fk_two_tables,
        "fk_two_tables_outcomes": fk_two_tables_outcomes,
        "quarantine": quarantine_q,
        "restrict_unknown_col": restrict_unknown_col,
        "restrict_non_key": restrict_non_key,
        "apply_barriers": apply_barriers,
        "restrict_null": restrict_null,
        "unique_all_tiers": unique_all_tiers,
        "unique_all_tiers_outcomes": unique_all_tiers_outcomes,
        "key_move_partial": key_move_partial,
        "pipeline_key_move": pipeline_key_move,
        "pipeline_barriers": pipeline_barriers,
        "apply_key_move": apply_key_move,
        "key_move_outcomes": key_move_outcomes,
        "apply_unique_mixed": apply_unique_mixed,
        "reject_duplicate_unique": reject_duplicate_unique,
        "outcomes_complete": outcomes_complete,
        "pipeline_stream": pipeline_stream,
        "stream_late_packets": stream_late_packets,
        "stream_restart": stream_restart,
        "target_catch_up": target_catch_up,
    }
