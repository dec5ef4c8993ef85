"""Fixtures derived from the driver tables (every one grows with them).

Each builder takes ``(spark, sf_dir)`` and returns DataFrames; ``oracles.py`` derives the same data
in DuckDB SQL. Packets are real envelopes (``seq, action, data MAP, restriction MAP``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.contract import ForeignKey, TableContract
from rowtide.functions.packets import map_of
from rowtide.sources.tables import read_table

# ---- fixed values of the fixtures (must equal the oracle SQL)
NEW_ACCOUNT_K = 3  # events whose props.k is a multiple name an account that the base lacks: the negative id
EVENT_ACTIONS = {"signup": "add", "click": "set", "purchase": "set", "view": "update", "error": "delete"}
DEFAULT_SEGMENT = "DEF"

ACCOUNTS = TableContract(
    name="accounts",
    columns=(("user_id", "bigint"), ("value", "double"), ("segment", "string")),
    primary_key=("user_id",),
    required=frozenset({"value"}),
    defaults={"segment": DEFAULT_SEGMENT},
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ------------------------------------------------------------------ accounts (events -> packets)
def accounts_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").cast("bigint").alias("user_id"),
        F.col("c_acctbal").alias("value"),
        F.col("c_mktsegment").alias("segment"),
    )


def _event_k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def accounts_log_columns(events: DataFrame) -> DataFrame:
    """Flat view of the log: per event its action and the present/absent columns."""
    k = _event_k()
    action = F.col("event_type")
    mapping = F.create_map(*[x for kv in EVENT_ACTIONS.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    seg_value = F.when(k % 7 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("S"), (k % 5).cast("string")))
    return events.select(
        F.col("event_id").alias("seq"),
        mapping[action].alias("action"),
        F.col("ts"),
        F.when(k % NEW_ACCOUNT_K == 0, -F.col("user_id")).otherwise(F.col("user_id")).alias("user_id"),
        F.col("value"),
        action.isin("signup", "click", "view").alias("has_value"),
        ((action == "purchase") | ((action == "signup") & (F.col("value") >= 50))).alias("has_segment"),
        seg_value.alias("segment"),
    )


def accounts_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packets: signup->add, click/purchase->set, view->update (with an unknown column), error->delete."""
    f = accounts_log_columns(table(spark, sf_dir, "events"))
    a = F.col("action")
    data = map_of(
        {"user_id": F.col("user_id"), "value": F.col("value"), "segment": F.col("segment"), "timestamp": F.col("ts")},
        {
            "user_id": a.isin("add", "set"),
            "value": F.col("has_value"),
            "segment": F.col("has_segment"),
            "timestamp": a == "update",
        },
    )
    restriction = map_of({"user_id": F.col("user_id")})
    return f.select(
        "seq",
        "action",
        F.when(a != "delete", data).alias("data"),
        F.when(a.isin("update", "delete"), restriction).alias("restriction"),
        "ts",
    )


# ------------------------------------------------------------------ lines (composite key, partial-key packets)
LINES = TableContract(
    name="lines",
    columns=(("l_orderkey", "bigint"), ("l_linenumber", "int"), ("tax", "double")),
    primary_key=("l_orderkey", "l_linenumber"),
    required=frozenset({"tax"}),
)
LINE_ADDED = 9  # line number that no order has, added by full-key sets
LINE_ADD_PRIORITIES = ("1-URGENT", "2-HIGH")
LINE_FLAT_PRIORITY = "5-LOW"
LINE_FLAT_TAX = 0.25
LINE_ADDED_TAX = 0.01


def lines_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return (
        li.groupBy("l_orderkey", "l_linenumber")
        .agg(F.min("l_tax").alias("tax"))
        .select(F.col("l_orderkey").cast("bigint"), F.col("l_linenumber").cast("int"), "tax")
    )


def lines_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: (0) full-key set of a new line for urgent/high orders; (1) a packet naming only the
    order (F: delete, P: update tax, O: set tax); (2) a flat-tax set naming only the order for low
    priority orders. seq = o_orderkey * 10 + i."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    add_line = o.where(F.col("o_orderpriority").isin(*LINE_ADD_PRIORITIES)).select(
        (key * 10).alias("seq"), F.lit("set").alias("action"),
        map_of({"l_orderkey": key, "l_linenumber": F.lit(LINE_ADDED), "tax": F.lit(LINE_ADDED_TAX)}).alias("data"),
        F.lit(None).cast("map<string,string>").alias("restriction"),
    )
    st = F.col("o_orderstatus")
    action = F.when(st == "F", "delete").when(st == "P", "update").otherwise("set")
    by_order = o.select(
        (key * 10 + 1).alias("seq"), action.alias("action"),
        F.when(st == "P", map_of({"tax": F.col("o_totalprice")}))
        .when(st == "O", map_of({"l_orderkey": key, "tax": F.col("o_totalprice")})).alias("data"),
        F.when(st != "O", map_of({"l_orderkey": key})).alias("restriction"),
    )
    flat = o.where(F.col("o_orderpriority") == LINE_FLAT_PRIORITY).select(
        (key * 10 + 2).alias("seq"), F.lit("set").alias("action"),
        map_of({"l_orderkey": key, "tax": F.lit(LINE_FLAT_TAX)}).alias("data"),
        F.lit(None).cast("map<string,string>").alias("restriction"),
    )
    return add_line.unionByName(by_order).unionByName(flat)


# ------------------------------------------------------------------ order snapshots (capture)
ORDERS = TableContract(
    name="public.orders",
    columns=(
        ("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"),
        ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string"),
    ),
    primary_key=("o_orderkey",),
    required=frozenset({"o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"}),
)
# new snapshot = old minus (5-LOW, F), price + 1 for (3-MEDIUM, O), plus copies of (1-URGENT, P) under new keys
SNAP_DROP = ("5-LOW", "F")
SNAP_CHANGE = ("3-MEDIUM", "O")
SNAP_COPY = ("1-URGENT", "P")


def snap_old(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, f"{sf_dir.rstrip('/')}/orders.parquet", ORDERS)


def snap_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = snap_old(spark, sf_dir)
    pr, st = F.col("o_orderpriority"), F.col("o_orderstatus")
    kept = old.where(~((pr == SNAP_DROP[0]) & (st == SNAP_DROP[1]))).withColumn(
        "o_totalprice",
        F.when((pr == SNAP_CHANGE[0]) & (st == SNAP_CHANGE[1]), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")),
    )
    # one-row aggregate joined on a constant: a proven broadcast bound
    offset = old.agg((F.max("o_orderkey") + 1).alias("__off")).withColumn("__one", F.lit(1))
    copies = (
        old.where((pr == SNAP_COPY[0]) & (st == SNAP_COPY[1])).withColumn("__one", F.lit(1))
        .join(F.broadcast(offset), "__one")
        .withColumn("o_orderkey", F.col("o_orderkey") + F.col("__off"))
        .drop("__one", "__off")
    )
    return kept.unionByName(copies)


CUSTOMERS = TableContract(
    name="public.customer",
    columns=(("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"), ("c_mktsegment", "string")),
    primary_key=("c_custkey",),
)
CUSTOMER_CHANGED_SEGMENT = "BUILDING"
REGISTRY_ROWS = [("public", "orders", None, '["o_orderkey"]')]


def customer_old(spark, sf_dir):
    return read_table(spark, f"{sf_dir.rstrip('/')}/customer.parquet", CUSTOMERS)


def customer_new(spark, sf_dir):
    c = customer_old(spark, sf_dir)
    return c.withColumn(
        "c_acctbal", F.when(F.col("c_mktsegment") == CUSTOMER_CHANGED_SEGMENT, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))
    )


def capture_registry(spark: SparkSession) -> DataFrame:
    """Capture registry: one row per captured table (configuration, not data)."""
    return spark.createDataFrame(REGISTRY_ROWS, "schema_name string, table_name string, queue_name string, primary_key string")


# ------------------------------------------------------------------ wire packets (JSON text)
# Corruptions injected into the encoded accounts log, chosen by the event's props.k value.
JSON_MALFORMED_K = 97
JSON_UNKNOWN_ACTION_K = 89
JSON_EMPTY_RESTRICTION_K = 83
JSON_UNKNOWN_RESTRICTION_K = 79
JSON_BAD_VALUE_K = 73
UNKNOWN_ACTION = "merge"
BAD_VALUE = "n/a"


def json_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The accounts log as JSON bodies (``pos``, ``body``), with malformed / unknown-action /
    empty-restriction / unknown-restriction-column / bad-value packets mixed in."""
    from rowtide.functions.packets import JSON_OPTIONS

    ev = table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))
    log = accounts_log(spark, sf_dir).join(ev.withColumnRenamed("event_id", "seq"), "seq")
    k, a = F.col("k"), F.col("action")
    action = F.when(k == JSON_UNKNOWN_ACTION_K, F.lit(UNKNOWN_ACTION)).otherwise(a)
    restriction = (
        F.when((k == JSON_EMPTY_RESTRICTION_K) & a.isin("update", "delete"), F.create_map().cast("map<string,string>"))
        .when((k == JSON_UNKNOWN_RESTRICTION_K) & (a == "update"),
              F.map_concat(F.col("restriction"), F.create_map(F.lit("timestamp"), F.col("ts").cast("string"))))
        .otherwise(F.col("restriction"))
    )
    data = F.when((k == JSON_BAD_VALUE_K) & a.isin("add", "set") & F.map_contains_key("data", "value"),
                  F.map_concat(F.map_filter("data", lambda kk, v: kk != "value"), F.create_map(F.lit("value"), F.lit(BAD_VALUE)))
                  ).otherwise(F.col("data"))
    body = F.to_json(F.struct(F.col("seq"), action.alias("action"), data.alias("data"), restriction.alias("restriction")), JSON_OPTIONS)
    body = F.when(k == JSON_MALFORMED_K, F.concat(F.lit("{not json "), F.col("seq").cast("string"))).otherwise(body)
    return log.select(F.col("seq").alias("pos"), body.alias("body"))


# ------------------------------------------------------------------ client verbs on a frame
VERB_DELETE_SEGMENT = "AUTOMOBILE"
VERB_UPDATE_SEGMENT = "BUILDING"


# ------------------------------------------------------------------ topology (configuration)
ROUTES = [
    ("accounts", "replica_a", "/queue/accounts.replica_a", "public.accounts", True),
    ("accounts", "replica_b", "/queue/accounts.replica_b", "public.accounts", False),
    ("lines", "replica_a", "/queue/lines.replica_a", "public.lines", True),
    ("lines", "replica_b", "/queue/lines.replica_b", "public.lines", True),
]
SOFT_DELETE_SEGMENT = "DELETED"
STATS_WORKERS = 4
STATS_INTERVAL = "1 hour"


def routes(spark: SparkSession) -> DataFrame:
    from rowtide.operators.distribute import ROUTES_DDL

    return spark.createDataFrame(ROUTES, ROUTES_DDL)


def accounts_target_bases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """replica_a starts from the destination's base, replica_b from an empty table."""
    return accounts_base(spark, sf_dir).withColumn("target", F.lit("replica_a"))


# a replica with one more column: the time stamp that update packets carry and the destination doesn't know
STAMPED_ACCOUNTS = TableContract(
    name="accounts", columns=(*ACCOUNTS.columns, ("timestamp", "timestamp_ntz")), primary_key=ACCOUNTS.primary_key, required=ACCOUNTS.required, defaults=ACCOUNTS.defaults,
)
TARGET_ROUTES = [("accounts", t, f"/queue/accounts.{t}", "public.accounts", True) for t in ("replica_a", "replica_b", "replica_c")]


def stamped_target_bases(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = accounts_base(spark, sf_dir).withColumn("timestamp", F.lit(None).cast("timestamp_ntz"))
    return base.withColumn("target", F.explode(F.array(*[F.lit(r[1]) for r in TARGET_ROUTES])))


# ------------------------------------------------------------------ pages (unique-key upsert)
PAGES = TableContract(
    name="pages",
    columns=(("page_id", "bigint"), ("url", "string"), ("html", "string")),
    primary_key=("page_id",),
    unique_keys=(("url",),),
    required=frozenset({"url", "html"}),
    surrogate="page_id",
)
PAGE_MISS_MARK = "?page="  # urls with this part are altered -> no row matches -> new page
PAGE_PK_MARK = "utm_source"  # these packets name the page by id
PAGE_URL_SUFFIX = "&v=2"
PAGE_HTML_SUFFIX = "<!-- v2 -->"


def pages_base(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(F.col("page_id").cast("bigint"), "url", "html")


def page_set(spark, sf_dir):
    """``set`` per page: by id (utm urls), by url (most), or by an altered url that matches nothing."""
    p = pages_base(spark, sf_dir)
    miss = F.col("url").contains(PAGE_MISS_MARK)
    by_pk = F.col("url").contains(PAGE_PK_MARK) & ~miss
    html = F.concat(F.col("html"), F.lit(PAGE_HTML_SUFFIX))
    url = F.when(miss, F.concat(F.col("url"), F.lit(PAGE_URL_SUFFIX))).otherwise(F.col("url"))
    data = map_of({"page_id": F.col("page_id"), "url": url, "html": html}, {"page_id": by_pk, "url": ~by_pk})
    return p.select(F.col("page_id").alias("seq"), F.lit("set").alias("action"), data.alias("data"),
                    F.lit(None).cast("map<string,string>").alias("restriction"))


# ------------------------------------------------------------------ surrogate keys (documents)
SURROGATES = TableContract(
    name="notes",
    columns=(("note_id", "bigint"), ("body", "string")),
    primary_key=("note_id",),
    required=frozenset({"body"}),
    surrogate="note_id",
)
DOCS_ADD_LANGS = ("en", "de")  # these documents arrive as add, the others as keyless set


def surrogate_base(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("bigint").alias("note_id"), F.col("text").alias("body"))


def docs_add(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("seq"),
        F.when(F.col("lang").isin(*DOCS_ADD_LANGS), "add").otherwise("set").alias("action"),
        map_of({"body": F.col("text")}).alias("data"),
        F.lit(None).cast("map<string,string>").alias("restriction"),
    )


# ------------------------------------------------------------------ labels (foreign key to documents)
LABELS = TableContract(
    name="labels",
    columns=(("doc_id", "bigint"), ("quality", "int"), ("toxic", "int")),
    primary_key=("doc_id",),
    required=frozenset({"quality", "toxic"}),
    foreign_keys=(ForeignKey(("doc_id",), ("doc_id",), "documents"),),
)
PARENT_MISSING_LANG = "de"  # German documents are not in the parent table


def label_parents(spark, sf_dir):
    return table(spark, sf_dir, "documents").where(F.col("lang") != PARENT_MISSING_LANG).select("doc_id")


def label_add(spark, sf_dir):
    lab = table(spark, sf_dir, "labels")
    return lab.select(F.col("doc_id").alias("seq"), F.lit("add").alias("action"),
                      map_of({"doc_id": F.col("doc_id"), "quality": F.col("quality"), "toxic": F.col("toxic")}).alias("data"),
                      F.lit(None).cast("map<string,string>").alias("restriction"))


RELATED_LABELS = TableContract(
    name="labels", columns=(("label_id", "bigint"), ("doc_id", "bigint"), ("quality", "int")), primary_key=("label_id",),
    foreign_keys=(ForeignKey(("doc_id",), ("doc_id",), "documents"),),
)
DOCUMENTS = TableContract(name="documents", columns=(("doc_id", "bigint"), ("lang", "string")), primary_key=("doc_id",))


def documents_base(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "lang")


def related_logs(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Documents and their labels in one order, seq = doc_id * 10 + i: (1) even documents get their label; (3) every document is
    deleted, which its label refuses; (5) the labels of odd documents come too late; (7) documents take a key beyond
    all others, which their labels follow."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    k, no = F.col("doc_id"), F.lit(None).cast("map<string,string>")
    off = docs.agg((F.max("doc_id") + 1).alias("__off")).withColumn("__one", F.lit(1))  # one row
    d = docs.withColumn("__one", F.lit(1)).join(F.broadcast(off), "__one")
    row = map_of({"label_id": k, "doc_id": k, "quality": F.col("quality")})
    child = labels.select((k * 10 + F.when(k % 2 == 0, 1).otherwise(5)).alias("seq"), F.lit("add").alias("action"), row.alias("data"), no.alias("restriction"))
    drop = docs.select((k * 10 + 3).alias("seq"), F.lit("delete").alias("action"), no.alias("data"), map_of({"doc_id": k}).alias("restriction"))
    move = d.select((k * 10 + 7).alias("seq"), F.lit("update").alias("action"), map_of({"doc_id": k + F.col("__off")}).alias("data"), map_of({"doc_id": k}).alias("restriction"))
    return drop.unionByName(move), child


def empty_like(spark, contract: TableContract) -> DataFrame:
    return spark.createDataFrame([], contract.schema)


# ------------------------------------------------------------------ barriers (restrictions on non-key columns)
# priority names used as segment values by the order sets; barrier of region r restricts on the r-th one
BARRIER_SEGMENTS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def barrier_log(spark, sf_dir, on: str) -> DataFrame:
    """Order sets (seq = o_orderkey*10) writing c_mktsegment, plus one barrier per region at
    seq = (2r+1) * max(o_orderkey) * 10 + 5: even regions update c_acctbal, odd regions delete, restricted
    on c_nationkey (``on='nation'``: immutable column) or on c_mktsegment (``on='segment'``: mutable)."""
    o = table(spark, sf_dir, "orders")
    sets = o.select(
        (F.col("o_orderkey") * 10).alias("seq"), F.lit("set").alias("action"),
        map_of({"c_custkey": F.col("o_custkey"), "c_mktsegment": F.col("o_orderpriority")}).alias("data"),
        F.lit(None).cast("map<string,string>").alias("restriction"),
    )
    top = o.agg(F.max("o_orderkey").alias("__max")).withColumn("__one", F.lit(1))  # one row
    regions = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.min("n_nationkey").alias("n"))
    r = F.col("n_regionkey")
    seg = F.element_at(F.array(*[F.lit(s) for s in BARRIER_SEGMENTS]), (r % len(BARRIER_SEGMENTS)).cast("int") + 1)
    restr = map_of({"c_nationkey": F.col("n")}) if on == "nation" else map_of({"c_mktsegment": seg})
    even = r % 2 == 0
    barriers = regions.withColumn("__one", F.lit(1)).join(F.broadcast(top), "__one").select(
        ((2 * r + 1) * F.col("__max") * 10 + 5).alias("seq"),
        F.when(even, "update").otherwise("delete").alias("action"),
        F.when(even, map_of({"c_acctbal": F.lit(0.0) if on == "nation" else F.lit(-1.0)})).alias("data"),
        restr.alias("restriction"),
    )
    return sets.unionByName(barriers)


# ------------------------------------------------------------------ key moves
MOVE_STATUS = "P"  # these orders move to key + (max + 1)
GHOST_STATUS = "O"  # these packets try to move a key that does not exist


def key_move_log(spark, sf_dir) -> DataFrame:
    old = snap_old(spark, sf_dir)
    off = old.agg((F.max("o_orderkey") + 1).alias("__off")).withColumn("__one", F.lit(1))  # one row
    o = old.withColumn("__one", F.lit(1)).join(F.broadcast(off), "__one")
    ghost, moving = F.col("o_orderstatus") == GHOST_STATUS, F.col("o_orderstatus") == MOVE_STATUS
    old_key = F.when(ghost, F.col("o_orderkey") + 2 * F.col("__off")).otherwise(F.col("o_orderkey"))
    new_key = F.when(ghost, F.col("o_orderkey") + 3 * F.col("__off")).when(moving, F.col("o_orderkey") + F.col("__off")).otherwise(F.col("o_orderkey"))
    row = {c: (new_key if c == "o_orderkey" else F.col(c)) for c in ORDERS.names}
    return o.select(F.col("o_orderkey").alias("seq"), F.lit("update").alias("action"), map_of(row).alias("data"),
                    map_of({"o_orderkey": old_key}).alias("restriction"))


MOVED_PRIORITY = "MOVED"
LOST_PRIORITY = "LOST"


def key_move_partial_log(spark, sf_dir) -> DataFrame:
    """Three packets per order, seq = o_orderkey * 4 + i: (0) orders of one status move their key, naming nothing else; all
    orders (1) get a new priority by the key that they have now, and (2) another one by a key that is free."""
    old = snap_old(spark, sf_dir)
    off = old.agg((F.max("o_orderkey") + 1).alias("__off")).withColumn("__one", F.lit(1))  # one row
    o = old.withColumn("__one", F.lit(1)).join(F.broadcast(off), "__one")
    k, moving = F.col("o_orderkey"), F.col("o_orderstatus") == MOVE_STATUS
    now, free = k + F.when(moving, F.col("__off")).otherwise(0), k + F.when(moving, F.lit(0)).otherwise(F.col("__off"))

    def packet(i: int, rows: DataFrame, data: dict, key: Column) -> DataFrame:
        return rows.select((k * 4 + i).alias("seq"), F.lit("update").alias("action"), map_of(data).alias("data"), map_of({"o_orderkey": key}).alias("restriction"))

    return (
        packet(0, o.where(moving), {"o_orderkey": k + F.col("__off")}, k)
        .unionByName(packet(1, o, {"o_orderpriority": F.lit(MOVED_PRIORITY)}, now))
        .unionByName(packet(2, o, {"o_orderpriority": F.lit(LOST_PRIORITY)}, free))
    )


ORDER_ROUTES = [("orders", "replica_a", "/queue/orders.replica_a", "public.orders", True)]
CUSTOMER_ROUTES = [("customers", "replica_a", "/queue/customers.replica_a", "public.customer", True), ("customers", "replica_b", "/queue/customers.replica_b", "public.customer", True)]


def customer_target_bases(spark, sf_dir):
    """replica_a starts from the destination's base, replica_b lacks the customers of odd nations."""
    c = customer_old(spark, sf_dir)
    return c.withColumn("target", F.lit("replica_a")).unionByName(c.where(F.col("c_nationkey") % 2 == 0).withColumn("target", F.lit("replica_b")))


NAMED_CUSTOMERS = TableContract(name="public.customer", columns=CUSTOMERS.columns, primary_key=("c_custkey",), unique_keys=(("c_name",),))


def named_customer_log(spark, sf_dir) -> DataFrame:
    """A unique column in every tier: (1) per nation, all its customers take one name, which halts unless there is one; (2)
    customers of odd nations are deleted by nation; (3) every customer is added again under a negative key, with its old
    name: refused where another row still has it; (4) a restriction to NULL, which hits nothing."""
    nations = table(spark, sf_dir, "nation")
    n, no = F.col("n_nationkey"), F.lit(None).cast("map<string,string>")
    by = map_of({"c_nationkey": n})
    rename = nations.select(n.cast("bigint").alias("seq"), F.lit("update").alias("action"), map_of({"c_name": F.col("n_name")}).alias("data"), by.alias("restriction"))
    drop = nations.where(n % 2 == 1).select((n + 1000).cast("bigint").alias("seq"), F.lit("delete").alias("action"), no.alias("data"), by.alias("restriction"))
    c = customer_old(spark, sf_dir)
    again = {x: (-F.col("c_custkey") - 1 if x == "c_custkey" else F.col(x)) for x in CUSTOMERS.names}
    add = c.select((F.col("c_custkey") + 10_000).alias("seq"), F.lit("add").alias("action"), map_of(again).alias("data"), no.alias("restriction"))
    nothing = nations.select((n + 2000).cast("bigint").alias("seq"), F.lit("delete").alias("action"), no.alias("data"), map_of({"c_name": F.lit(None).cast("string")}).alias("restriction"))
    return rename.unionByName(drop).unionByName(add).unionByName(nothing)


# ------------------------------------------------------------------ unique keys in one log
TWIN_SUFFIX = "#twin"
GONE_SUFFIX = "#gone"


def unique_log(spark, sf) -> DataFrame:
    """Four packets per page, seq = page_id * 10 + i: (0) every third page: keyless add of a twin url; (1) set of the twin
    url (hits it or creates it); (2) the page itself takes another url; (3) set of the old url, free now: a new row; and
    (4) an add by key of the twin url, which is taken."""
    p = pages_base(spark, sf)
    k, no = F.col("page_id"), F.lit(None).cast("map<string,string>")
    twin, html = F.concat("url", F.lit(TWIN_SUFFIX)), F.concat(F.lit("n"), F.col("page_id").cast("string"))

    def packet(i: int, action: str, data, restriction=no, rows=p) -> DataFrame:
        return rows.select((k * 10 + i).alias("seq"), F.lit(action).alias("action"), map_of(data).alias("data"), restriction.alias("restriction"))

    return (
        packet(0, "add", {"url": twin, "html": html}, rows=p.where(k % 3 == 0))
        .unionByName(packet(1, "set", {"url": twin, "html": F.concat(html, F.lit("s"))}))
        .unionByName(packet(2, "update", {"url": F.concat("url", F.lit(GONE_SUFFIX))}, map_of({"page_id": k}), rows=p.where(k % 3 == 1)))
        .unionByName(packet(3, "set", {"url": F.col("url"), "html": html}, rows=p.where(k % 3 == 1)))
        .unionByName(packet(4, "add", {"page_id": -k - 1, "url": twin, "html": html}))
    )
