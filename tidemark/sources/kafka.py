"""Options of Spark's Kafka source and sink, built from tables of this library.

Only dictionaries are built here; pass them to ``spark.read.format("kafka")`` or
``spark.readStream.format("kafka")`` where the connector is installed.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidemark.options import INITIAL, OptionError
from tidemark.schemas import TP
from tidemark.sources.topic_log import topic_list

MAX_PARTITIONS = 200_000


def starting_offsets(starts: DataFrame) -> str:
    """Start positions as the JSON of the ``startingOffsets`` option.

    The option is one string on the driver, so more than ``MAX_PARTITIONS``
    topic-partitions are an error.
    """
    rows = starts.select(*TP, "initial_offset").limit(MAX_PARTITIONS + 1).collect()
    if len(rows) > MAX_PARTITIONS:
        raise ValueError(f"more than {MAX_PARTITIONS} topic-partitions")
    nested: dict[str, dict[str, int]] = {}
    for r in sorted(rows, key=lambda r: (r.topic, r.partition)):
        nested.setdefault(r.topic, {})[str(r.partition)] = r.initial_offset
    return json.dumps(nested)


def kafka_read_options(
    servers: str,
    topics: DataFrame | Sequence[str],
    starts: DataFrame | None = None,
    initial: str = "newest",
    stream: bool = True,
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """Options to read the topics from their start positions.

    Topics are an explicit list: a subscribe pattern has no blacklist, and skips the
    rules for explicitly named topics.
    """
    if initial not in INITIAL:
        raise OptionError("initial must be oldest or newest")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topic_list(topics)),
        "failOnDataLoss": "false",
    }
    if starts is not None:
        options["startingOffsets"] = starting_offsets(starts)
    elif stream or initial == "oldest":
        options["startingOffsets"] = "earliest" if initial == "oldest" else "latest"
    if stream and max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def kafka_write_options(servers: str, topic: str | None = None) -> dict[str, str]:
    """Options to write messages; without ``topic`` the topic column decides."""
    options = {"kafka.bootstrap.servers": servers}
    if topic is not None:
        options["topic"] = topic
    return options
