"""JSON messages to typed readings and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattspan.functions.metrics import ColumnOrName, as_column
from wattspan.schemas import WIRE_FIELDS, struct_of

# Six fraction digits, so event time survives a round trip through JSON.
JSON_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
BAD_JSON = "_bad_json"


def expand_once(df: DataFrame, struct: Column, *keep: ColumnOrName) -> DataFrame:
    """The kept columns and the fields of ``struct``, made once per row.

    A filter on a plain projection is moved below it, and repeats there the
    expression of every column it tests: a JSON message would be parsed again
    for each. Filters on generated fields stay above the generator.
    """
    return df.select(*keep, F.inline_outer(F.array(struct)))


def parse_readings(
    messages: DataFrame,
    keep: Sequence[str] = (),
    fields: Sequence[str] | None = None,
    keep_bad: bool = False,
) -> DataFrame:
    """Decode the JSON in ``value`` with the fixed schema, one column per field.

    Decoding is permissive: text that is no JSON gives a row of NULLs, a field
    of the wrong type gives NULL for that field. ``keep`` names columns of the
    message to keep, such as ``value`` or a Kafka ``offset``. ``fields`` names
    the fields to decode, by default all; ``timestamp`` is always among them.
    With ``keep_bad`` the text of a faulty message stays in ``_bad_json``.
    """
    wanted = [f for f in WIRE_FIELDS if fields is None or f in fields or f == "timestamp"]
    schema = {f: WIRE_FIELDS[f] for f in wanted}
    text = F.col("value").cast("string")
    if keep_bad:
        options = {"columnNameOfCorruptRecord": BAD_JSON}
        decoded = F.from_json(text, struct_of({**schema, BAD_JSON: "string"}), options)
    else:
        decoded = F.from_json(text, struct_of(schema))
    return with_event_time(expand_once(messages, decoded, *keep))


def event_time(text: ColumnOrName) -> Column:
    """ISO-8601 text with offset to a timestamp; NULL when malformed."""
    return F.try_to_timestamp(as_column(text))


def with_event_time(df: DataFrame) -> DataFrame:
    """Type the ``timestamp`` column."""
    return df.withColumn("timestamp", event_time("timestamp"))


def with_processed_at(df: DataFrame) -> DataFrame:
    """Stamp rows with the time of processing (of the micro-batch, on a stream)."""
    return df.withColumn("processed_at", F.current_timestamp())


def to_messages(df: DataFrame, key: ColumnOrName = "region") -> DataFrame:
    """Rows as keyed JSON messages.

    The default key keeps one region's messages in order on one topic
    partition. When a region is hot, pass e.g. ``"grid_id"`` to spread it.
    """
    body = F.to_json(F.struct("*"), {"timestampFormat": JSON_TIMESTAMP})
    return df.select(as_column(key).cast("string").alias("key"), body.alias("value"))
