"""Fixed schemas of the tables the operators exchange."""

from __future__ import annotations

from pyspark.sql import types as T

# The two symbolic start positions and the "no commit" offset.
OFFSET_OLDEST = -2
OFFSET_NEWEST = -1
NO_OFFSET = -1

TP = ["topic", "partition"]

TOPIC_LOG = T.StructType(
    [
        T.StructField("topic", T.StringType(), False),
        T.StructField("partition", T.IntegerType(), False),
        T.StructField("offset", T.LongType(), False),
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)
CATALOG = "topic string, partition int"
BOUNDS = "topic string, partition int, oldest bigint, newest bigint"
COMMITTED = "topic string, partition int, offset bigint, metadata string"
STASH = COMMITTED
OFFSET_STATE = "topic string, partition int, offset bigint, metadata string, dirty boolean"
COMMANDS = "seq bigint, topic string, partition int, op string, offset bigint, metadata string"
MEMBERS = "generation int, member_id string, topic string, user_data binary"
ASSIGNMENTS = "generation int, member_id string, topic string, partition int"
FAILURES = "generation int, member_id string, stage string"
ERRORS = "ctx string, topic string, partition int, offset bigint, message string"
COMMITS = (
    "group_id string, member_id string, generation int, topic string, partition int, "
    "offset bigint, metadata string, retention_ms bigint, committed_at timestamp, batch_id bigint"
)
#: Commits as stored: the writer says which attempts replace each other.
COMMIT_LOG = f"{COMMITS}, writer string"
GENERATIONS = "group_id string, generation int, member_id string, opened_at timestamp"
COMMIT_RESULTS = "topic string, partition int, offset bigint, error string"
STARTS = (
    "topic string, partition int, state_offset bigint, metadata string, "
    "initial_offset bigint, resolved_offset bigint, how string"
)
