"""Deterministic event identity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from railweave.functions.gtfs_time import iso_text

# JSON's short escapes.
SHORT_ESCAPES = {
    '"': '\\"', "\\": "\\\\", "\n": "\\n", "\r": "\\r", "\t": "\\t", "\b": "\\b", "\f": "\\f",
}


def json_text(value: Column) -> Column:
    """JSON string literal in pure ASCII, or ``null``.

    Needed because the id is a hash of this text and ``to_json`` leaves other scripts unescaped.
    """
    def escaped(char: Column) -> Column:
        chain = F.when(char.rlike(r"^[ !#-\[\]-~]$"), char)
        for raw, text in SHORT_ESCAPES.items():
            chain = chain.when(char == raw, F.lit(text))
        units = F.hex(F.encode(char, "UTF-16BE"))
        return chain.otherwise(F.lower(F.regexp_replace(units, "(.{4})", r"\\u$1")))

    # Most texts need no escape.
    plain = value.rlike(r"^[ !#-\[\]-~]*\z")
    inner = F.when(plain, value).otherwise(F.array_join(F.transform(F.split(value, ""), escaped), ""))
    quoted = F.concat(F.lit('"'), F.when(value == "", F.lit("")).otherwise(inner), F.lit('"'))
    return F.when(value.isNull(), F.lit("null")).otherwise(quoted)


def build_event_id(source: Column, entity_id: Column, vehicle_id: Column, feed_time: Column) -> Column:
    """SHA-256 over the sorted-key JSON of what makes an observation unique."""
    members = {
        "entity_id": json_text(entity_id),
        "feed_timestamp": json_text(iso_text(feed_time)),
        "source": json_text(source),
        "vehicle_id": json_text(vehicle_id),
    }
    body = F.concat_ws(", ", *(F.concat(F.lit(f'"{k}": '), v) for k, v in members.items()))
    return F.sha2(F.concat(F.lit("{"), body, F.lit("}")), 256)
