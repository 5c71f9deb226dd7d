"""Canonical schemas shared by every operator."""

from pyspark.sql import types as T

TEXT_MAP = T.MapType(T.StringType(), T.StringType(), True)

SYNC = T.StructType([
    T.StructField("origin", T.StringType()),
    T.StructField("orig_tstamp", T.TimestampType()),
])

CHANGE_LOG = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("schema_name", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("session_user", T.StringType()),
    T.StructField("tstamp_tx", T.TimestampType()),
    T.StructField("tstamp_stm", T.TimestampType()),
    T.StructField("tstamp_clk", T.TimestampType()),
    T.StructField("tx_id", T.LongType()),
    T.StructField("client_query", T.StringType()),
    T.StructField("action", T.StringType()),
    T.StructField("row_data", TEXT_MAP),
    T.StructField("changed_fields", TEXT_MAP),
    T.StructField("statement_only", T.BooleanType()),
    T.StructField("sync", SYNC),
])

RECEIPTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("server_id", T.StringType()),
    T.StructField("sync_id", T.StringType()),
])

# Receipts of consecutive events as one row, both bounds included.
RECEIPT_RANGES = T.StructType([
    T.StructField("server_id", T.StringType()),
    T.StructField("lo", T.LongType()),
    T.StructField("hi", T.LongType()),
])

CONFLICTS = T.StructType([
    T.StructField("conflict_time", T.TimestampType()),
    T.StructField("ident", T.StringType()),
    T.StructField("uid", T.StringType()),
    T.StructField("field", T.StringType()),
    T.StructField("clone_id", T.StringType()),
    T.StructField("central_event_id", T.LongType()),
    T.StructField("central_tstamp", T.TimestampType()),
    T.StructField("central_sql", T.StringType()),
    T.StructField("clone_sql", T.StringType()),
    T.StructField("rejected", T.StringType()),
    T.StructField("rule_applied", T.StringType()),
])

# Append-only records; ``operators.history.fold_history`` gives the current state.
HISTORY_RECORDS = T.StructType([
    T.StructField("sync_id", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("sync_time", T.TimestampType()),
    T.StructField("server_from", T.StringType()),
    T.StructField("server_to", T.StringType()),
    T.StructField("min_event_id", T.LongType()),
    T.StructField("max_event_id", T.LongType()),
    T.StructField("max_tstamp_tx", T.TimestampType()),
    T.StructField("sync_type", T.StringType()),
    T.StructField("sync_status", T.StringType()),
])

RELATIONS = T.StructType([
    T.StructField("relation_name", T.StringType()),
    T.StructField("uid_column", T.StringType()),
])

SYNC_TABLES = T.StructType([
    T.StructField("server_id", T.StringType()),
    T.StructField("tables", T.ArrayType(T.StringType())),
])

# The last event id that a node has given.
LAST_EVENT = T.StructType([T.StructField("event_id", T.LongType())])

# The last batch of a stream that is part of a table.
PROGRESS = T.StructType([
    T.StructField("stream", T.StringType()),
    T.StructField("batch_id", T.LongType()),
])
