"""Event text rendering.

``[DATA] topic=<t> len=<n>`` plus `` payload=<bytes as text>`` when the data
is non-empty; ``[ERROR] topic=<t> msg=<m>`` for errors. ``len`` counts bytes.
Bytes that are not valid UTF-8 are replaced for display.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from routecast import schema as S

DEFAULT_ERROR_PREFIX = "[drain]"


def display_bytes(data: Column) -> Column:
    return F.make_valid_utf8(data.cast("string"))


def event_text(topic: Column, kind: Column, data: Column, err: Column) -> Column:
    """One log line per event."""
    topic = F.coalesce(topic, F.lit(""))
    err = F.coalesce(err, F.lit(""))
    size = F.octet_length(data)
    data_line = F.concat(
        F.lit(S.TEXT_DATA_PREFIX + " topic="),
        topic,
        F.lit(" len="),
        F.coalesce(size, F.lit(0)).cast("string"),
        F.when(size > 0, F.concat(F.lit(" payload="), display_bytes(data))).otherwise(F.lit("")),
    )
    error_line = F.concat(F.lit(S.TEXT_ERROR_PREFIX + " topic="), topic, F.lit(" msg="), err)
    return F.when(kind == S.EVENT_ERROR, error_line).otherwise(data_line)


def error_line(topic: Column, err: Column, prefix: str = DEFAULT_ERROR_PREFIX) -> Column:
    """Short error notice ``<prefix> <topic> <err>`` shown for error rows of
    a drained batch."""
    return F.concat_ws(" ", F.lit(prefix), topic, err)
