"""Inputs of the sync operators, derived by plain expressions from whole given tables.

Every event row is an edit seen by the centre and, with other values and a shifted clock, an edit
made at a clone.  Nothing is sampled or capped: the modulo terms vary the kind of edit from row to
row, and filters give a row its role (which events a clone has seen, which rows exist at first).
"""

from datetime import datetime

from pyspark.sql import functions as F

from starsync.operators.history import DONE, PARTIAL
from starsync.schemas import CHANGE_LOG, HISTORY_RECORDS, RELATIONS, SYNC_TABLES
from starsync.session import stage

CENTRAL_ID, CLONE_A, CLONE_B = "centre", "clone_a", "clone_b"
ROW_FIELDS = ("click", "view", "purchase", "signup", "error")
IDENTS = ("app.alerts", "app.users")
MARK_ID, MARK_TIME = 200, "2024-01-05 00:00:00"


def read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_PREPARED = {}


def prepared(spark, sf_dir, build, *args):
    """A derived input as a stored table, as logs and snapshots are in practice.

    It is written once per session and data set.  Without this each filter on a logged value
    would be pushed below the derivation and repeat its JSON parsing many times per row.
    """
    source = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/events.parquet")
    files = source.getFileSystem(spark._jsc.hadoopConfiguration())
    stamp = files.getFileStatus(source).getModificationTime()  # on whatever storage it is
    key = (spark.sparkContext.applicationId, sf_dir, stamp, build.__name__, args)
    if key not in _PREPARED:
        _PREPARED[key] = stage(build(spark, sf_dir, *args), build.__name__)
    return _PREPARED[key]


def _edits(spark, sf_dir):
    k = F.get_json_object("props", "$.k").cast("int")
    return read(spark, sf_dir, "events").select(
        (F.col("event_id") + 1).alias("event_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        "user_id",
        "event_type",
        k.alias("k"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("uid"),
        F.when(F.col("user_id") % 4 == 0, "alerts").otherwise("users").alias("table_name"),
    )


def _parsed(spark, sf_dir):
    """The edits as a stored table, for what reads them several times."""
    return prepared(spark, sf_dir, _edits)


def _tagged(letter):
    return F.concat(F.lit(letter), F.col("event_id").cast("string"))


def _pair(key, value):
    key = F.lit(key) if isinstance(key, str) else key
    return F.struct(key.alias("key"), value.cast("string").alias("value"))


def _row():
    note = F.when(F.col("k") % 2 == 1, F.concat(F.lit("n"), F.col("k").cast("string")))
    return F.map_from_entries(F.array(
        _pair("id", F.col("user_id")),
        _pair("uid", F.col("uid")),
        *[_pair(f, _tagged("o")) for f in ROW_FIELDS],
        _pair("note", note),
    ))


def _log(edits, action, changed, sync, tstamp):
    values = {
        "event_id": F.col("event_id"),
        "schema_name": F.lit("app"),
        "table_name": F.col("table_name"),
        "session_user": F.lit("driver"),
        "tstamp_tx": tstamp,
        "tstamp_stm": tstamp,
        "tstamp_clk": tstamp,
        "tx_id": F.floor(F.col("event_id") / 10),
        "client_query": F.lit(None),
        "action": action,
        "row_data": F.when(action != "T", _row()),
        "changed_fields": F.when(action == "U", changed),
        "statement_only": action == "T",
        "sync": sync,
    }
    return edits.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in CHANGE_LOG])


def _central_events(edits, action):
    k = F.col("k")
    note = F.when(k % 20 != 0, F.concat(F.lit("n"), k.cast("string")))
    changed = F.map_from_entries(F.array_compact(F.array(
        F.when(k != 98, _pair(F.col("event_type"), _tagged("v"))),
        F.when(k == 98, _pair("id", F.col("event_id"))),
        F.when(k % 10 == 0, _pair("note", note)),
    )))
    origin = F.when(k % 7 == 0, CLONE_A).when(k % 7 == 1, CLONE_B)
    original = F.when(
        origin.isNotNull() & (k % 2 == 0), F.col("ts") - F.expr("interval 1 hour")
    )
    sync = F.struct(origin.alias("origin"), original.alias("orig_tstamp"))
    return _log(edits, action, changed, sync, F.col("ts"))


def _clone_events(edits, action):
    k = F.col("k")
    changed = F.map_from_entries(F.array_compact(F.array(
        _pair(F.col("event_type"), _tagged("c")),
        F.when(k % 15 == 0, _pair("note", F.concat(F.lit("m"), k.cast("string")))),
    )))
    tstamp = F.col("ts") + F.make_dt_interval(hours=k % 5 - 2)
    return _log(edits, action, changed, F.lit(None), tstamp)


def central_log(spark, sf_dir):
    """The log of the centre: inserts, deletes, truncates, updates of one or two columns."""
    k = F.col("k")
    action = (
        F.when(k < 5, "I").when((k >= 5) & (k < 8), "D").when(k == 99, "T").otherwise("U")
    )
    return _central_events(_edits(spark, sf_dir), action)


def clone_log(spark, sf_dir):
    """The log of a clone, whose clock is up to two hours ahead or behind."""
    k = F.col("k")
    action = F.when(k.between(50, 53), "I").when(k.between(54, 55), "D").otherwise("U")
    return _clone_events(_edits(spark, sf_dir), action)


def _first(edits, name):
    return edits.groupBy("uid").agg(F.min("event_id").alias(name))


def _added_at_centre(spark, sf_dir):
    """Every third user whose row the centre inserts after the mark, and the event that does it."""
    return _first(_parsed(spark, sf_dir).filter(
        (F.col("user_id") % 3 == 0) & F.col("k").between(1, 4) & (F.col("event_id") > MARK_ID)
        & (F.col("ts") > F.lit(MARK_TIME).cast("timestamp"))), "added")


def star_base(spark, sf_dir):
    """The rows that centre and clone start from: those that the centre inserts are not among them."""
    return prepared(spark, sf_dir, base_rows).join(
        prepared(spark, sf_dir, _added_at_centre), "uid", "left_anti")


def star_central_log(spark, sf_dir):
    """A log that leads from ``star_base`` on: a row is inserted once, and before that its events
    are statements without rows."""
    k, event_id = F.col("k"), F.col("event_id")
    edits = _parsed(spark, sf_dir).join(prepared(spark, sf_dir, _added_at_centre), "uid", "left")
    action = (
        F.when(event_id == F.col("added"), "I").when((event_id < F.col("added")) | (k == 99), "T")
        .when(k.between(5, 7), "D").otherwise("U")
    )
    return _central_events(edits, action)


def star_clone_log(spark, sf_dir):
    """The clone's log from ``star_base`` on.

    It inserts rows that it lacks, also those that the centre inserts into a table that the clone does
    not receive: they clash at the centre.
    """
    edits, k, event_id = _parsed(spark, sf_dir), F.col("k"), F.col("event_id")
    held = prepared(spark, sf_dir, star_base).select("uid", F.lit(True).alias("held"))
    to_come = prepared(spark, sf_dir, _added_at_centre).join(
        edits.filter("table_name = 'users'").select("uid"), "uid", "left_semi")
    own = _first(
        edits.filter(k.between(50, 53)).join(held, "uid", "left_anti")
        .join(to_come, "uid", "left_anti"), "own")
    own_or_held = edits.join(held, "uid", "left").join(own, "uid", "left")
    missing = F.col("held").isNull() & (F.col("own").isNull() | (event_id < F.col("own")))
    action = (
        F.when(missing, "T").when(event_id == F.col("own"), "I").when(k.between(54, 55), "D")
        .otherwise("U")
    )
    return _clone_events(own_or_held, action)


def receipts(spark, sf_dir):
    """Events clone A has replayed already."""
    return _edits(spark, sf_dir).filter(F.col("k") % 11 == 0).select(
        "event_id", F.lit(CLONE_A).alias("server_id"), F.lit("earlier").alias("sync_id")
    )


def relations(spark):
    return spark.createDataFrame([(i, "id") for i in IDENTS], RELATIONS)


def sync_tables(spark, tables=("users",)):
    names = [f'"app"."{t}"' for t in tables]
    return spark.createDataFrame([(CLONE_A, names), (CLONE_B, names)], SYNC_TABLES)


def history_records(spark, clones=(CLONE_A, CLONE_B)):
    """One finished round per clone: the marks the pending queries start from."""
    mark = datetime.fromisoformat(MARK_TIME)
    return spark.createDataFrame(
        [
            (f"first-{c}", 1, mark, CENTRAL_ID, c, 1, MARK_ID, mark, PARTIAL, DONE)
            for c in clones
        ],
        HISTORY_RECORDS,
    )


def base_rows(spark, sf_dir):
    """Rows before the log: users whose first event is no signup, with a value per event type."""
    last = {
        f: F.concat(
            F.lit("b"),
            F.max(F.when(F.col("event_type") == f, F.col("event_id"))).cast("string"),
        )
        for f in ROW_FIELDS
    }
    return (
        _parsed(spark, sf_dir)
        .groupBy("user_id", "uid", "table_name")
        .agg(
            F.min_by("event_type", "event_id").alias("first_type"),
            *[value.alias(f) for f, value in last.items()],
        )
        .filter(F.col("first_type") != "signup")
        .select(
            F.concat(F.lit("app."), F.col("table_name")).alias("ident"),
            "uid",
            F.col("user_id").alias("id"),
            *ROW_FIELDS,
            F.lit(None).cast("string").alias("note"),
        )
    )


def edited_rows(spark, sf_dir, base, node):
    """The base rows after the edits of one of three nodes: every event is an edit of one of them.

    A node sets a cell to its last event for it, adds the rows of users that have none (each user is
    added at one node only) and removes the rows of some users (at one node only).
    """
    mine = _parsed(spark, sf_dir).filter(F.col("event_id") % 3 == node)
    cells = mine.groupBy("uid", "user_id", F.concat(F.lit("app."), F.col("table_name")).alias("ident")).agg(*[
        F.concat(F.lit(f"n{node}_"), F.max(F.when(F.col("event_type") == f, F.col("event_id")))
                 .cast("string")).alias(f"_{f}") for f in ROW_FIELDS])
    both = base.join(cells, ["ident", "uid"], "full_outer")
    removed = F.col("id").isNotNull() & (F.col("id") % 20 == node)
    added = F.col("id").isNotNull() | (F.col("user_id") % 3 == node)
    return both.filter(added & ~removed).select(
        "ident", "uid", F.coalesce("id", "user_id").alias("id"),
        *[F.coalesce(f"_{f}", f).alias(f) for f in ROW_FIELDS], "note")


def orders_old(spark, sf_dir):
    """Orders as one snapshot of a table with a stable uid and a local id."""
    return read(spark, sf_dir, "orders").select(
        F.md5(F.col("o_orderkey").cast("string")).alias("uid"),
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("custkey"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"),
        F.lit(1).cast("long").alias("batch"),
    )


def orders_new(spark, sf_dir):
    """The next snapshot: some orders purged or changed, one new order per customer."""
    old = orders_old(spark, sf_dir)
    kept = old.filter(~((F.col("status") == "F") & (F.col("priority") == "5-LOW")))
    edited = (
        kept.withColumn("batch", F.when(
            F.col("priority") == "3-MEDIUM", F.lit(2)).otherwise(F.col("batch")).cast("long"))
        .withColumn("status", F.when(
            (F.col("status") == "O") & (F.col("priority") == "2-HIGH"), "F",
        ).otherwise(F.col("status")))
        .withColumn("priority", F.when(
            (F.col("status") == "P") & (F.col("priority") == "1-URGENT"), F.lit(None),
        ).otherwise(F.col("priority")))
    )
    added = read(spark, sf_dir, "customer").select(
        F.md5(F.concat(F.lit("c"), F.col("c_custkey").cast("string"))).alias("uid"),
        (F.col("c_custkey") + 1_000_000_000).alias("id"),
        F.col("c_custkey").alias("custkey"),
        F.lit("O").alias("status"),
        F.lit(None).cast("string").alias("priority"),
        F.round(F.col("c_acctbal") * 100).cast("long").alias("cents"),
        F.lit(2).cast("long").alias("batch"),
    )
    return edited.unionByName(added)


def order_rounds(spark, sf_dir):
    """History records of the whole order book: an order is a sync round from the centre, its
    lines add each supplier nation once as a receiving clone, and a finished order closes it."""
    orders = read(spark, sf_dir, "orders")
    sync_id = F.md5(F.col("o_orderkey").cast("string"))
    none = {f.name: F.lit(None).cast(f.dataType) for f in HISTORY_RECORDS}

    def records(df, **values):
        return df.select(*[
            values.get(f.name, none[f.name]).cast(f.dataType).alias(f.name)
            for f in HISTORY_RECORDS
        ])

    clone = F.concat(F.lit("clone_"), F.col("c_nationkey").cast("string"))
    opened = records(
        orders.join(
            read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
        ),
        sync_id=sync_id, seq=F.lit(0), sync_time=F.col("o_orderdate"),
        server_from=F.lit(CENTRAL_ID),
        server_to=F.when(F.col("o_orderpriority") != "5-LOW", clone),
        min_event_id=F.lit(1), max_event_id=F.col("o_orderkey"),
        max_tstamp_tx=F.expr("timestamp'2024-01-01'") + F.make_dt_interval(
            hours=(F.col("o_custkey") % 720).cast("int")),
        sync_type=F.when(F.col("o_orderpriority") == "5-LOW", "full").otherwise("partial"),
        sync_status=F.lit("pending"),
    )
    added = records(
        read(spark, sf_dir, "lineitem").join(
            read(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")
        ).groupBy("l_orderkey", "s_nationkey").agg(
            F.min(1 + F.col("l_partkey") * 8 + F.col("l_linenumber")).alias("first")
        ),
        sync_id=F.md5(F.col("l_orderkey").cast("string")),
        seq=F.col("first"),
        server_to=F.concat(F.lit("clone_"), F.col("s_nationkey").cast("string")),
    )
    closed = records(
        orders.filter(F.col("o_orderstatus") != "P"),
        sync_id=sync_id, seq=F.lit(1 << 60), sync_status=F.lit("done"),
    )
    return opened.unionByName(added).unionByName(closed)


def server_tables(spark, sf_dir):
    """Table lists of the suppliers' nations: the brands and types of the parts they deliver."""
    quoted = F.concat(
        F.lit('"'), F.col("p_brand"), F.lit('"."'), F.col("p_type"), F.lit('"')
    )
    return (
        read(spark, sf_dir, "lineitem")
        .join(read(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(read(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.concat(F.lit("clone_"), F.col("s_nationkey").cast("string")).alias("server_id"),
            quoted.alias("table_name"),
            "l_returnflag",
        )
        .distinct()
    )


def table_lists(pairs):
    return pairs.groupBy("server_id").agg(
        F.array_sort(F.collect_set("table_name")).alias("tables")
    )
