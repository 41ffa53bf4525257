"""JSON event messages: writing them, and decoding them with a typed verdict per message."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railweave.functions.gtfs_time import iso_text
from railweave.schemas import EVENT_FIELDS

# Error classes and texts that the quality counts look for.
REQUIRED_FIELDS = ("event_id", "vehicle_id", "ingested_at", "entity_id", "source")
NO_VALUE = "Kafka message has no value"
NOT_UTF8 = "value is not valid UTF-8"
NOT_JSON = "value is not valid JSON"
NOT_OBJECT = "Kafka message value must decode to a JSON object"
MISSING_FIELDS = "Missing or invalid required event fields: "
BAD_INGESTED_AT = "ingested_at must be a valid ISO-8601 timestamp"
NAIVE_INGESTED_AT = "ingested_at must include a timezone"
BAD_TIMESTAMP = "Invalid isoformat string: "

# The form nearly all times have; Spark's own cast reads it.
USUAL_ISO_PATTERN = (
    r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?(?:Z|[+-]\d{2}:\d{2})$"
)
# Date, then optionally a separator, hours, minutes, seconds, fraction and offset.
ISO_PATTERN = (
    r"^(\d{4})-?(\d{2})-?(\d{2})"
    r"(?:.(\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d+))?)?)?"
    r"(Z|[+-]\d{2}(?::?\d{2}(?::?\d{2})?)?)?)?$"
)


def _iso_part(text: Column, group: int) -> Column:
    return F.regexp_extract(text, ISO_PATTERN, group)


def has_iso_offset(text: Column) -> Column:
    return text.rlike(USUAL_ISO_PATTERN) | (_iso_part(text, 8) != "")


def parse_iso(text: Column) -> Column:
    """Instant of an ISO-8601 text; UTC when it names no offset, NULL when it is malformed."""
    def part(group: int, default: str = "00") -> Column:
        return F.coalesce(F.nullif(_iso_part(text, group), F.lit("")), F.lit(default))

    offset = _iso_part(text, 8)
    digits = F.replace(offset, F.lit(":"), F.lit(""))
    zone = F.when(offset.isin("", "Z"), F.lit("+00:00")).otherwise(
        F.concat(
            F.substring(digits, 1, 3),
            F.lit(":"),
            F.rpad(F.substring(digits, 4, 2), 2, "0"),
        )
    )
    rebuilt = F.concat(
        F.concat_ws("-", part(1), part(2), part(3)),
        F.lit(" "),
        F.concat_ws(":", part(4), part(5), part(6)),
        F.lit("."),
        part(7, "0"),
        zone,
    )
    return F.when(text.rlike(USUAL_ISO_PATTERN), text.try_cast("timestamp")).when(
        text.rlike(ISO_PATTERN), rebuilt.try_cast("timestamp")
    )


def to_event_envelope(records: DataFrame) -> DataFrame:
    """(key, value): the record as JSON with sorted names and explicit nulls, keyed by event id."""
    def written(field: T.StructField) -> Column:
        column = F.col(field.name)
        is_time = isinstance(field.dataType, T.TimestampType)
        return (iso_text(column) if is_time else column).alias(field.name)

    fields = sorted(EVENT_FIELDS, key=lambda field: field.name)
    value = F.to_json(F.struct(*map(written, fields)), {"ignoreNullFields": "false"})
    return records.select(F.col("event_id").alias("key"), value.alias("value"))


def _kind(name: str) -> Column:
    """JSON type of a field, NULL when it is absent."""
    return F.col(f"kind_{name}")


def _text(name: str) -> Column:
    """The field's text if it is a JSON string, else NULL."""
    return F.when(_kind(name) == "STRING", F.col(f"text_{name}"))


# A JSON string, or what lies between two of them; and the numbers that only some writers emit.
_STRING_OR_REST = r'"(?:[^"\\]|\\.)*+"|[^"]+'
_NOT_FINITE = r"(?<![\w.])-?(?:NaN|Infinity)(?![\w.])"


def with_finite_numbers(text: Column) -> Column:
    """The text with ``NaN`` and infinities outside of strings replaced by another number, so that strict
    parsers take it. Their values are read from the text itself."""
    def finite(part: Column) -> Column:
        return F.when(part.startswith('"'), part).otherwise(F.regexp_replace(part, _NOT_FINITE, "0.5"))

    parts = F.regexp_extract_all(text, F.lit(_STRING_OR_REST), 0)
    odd = text.contains("NaN") | text.contains("Infinity")
    return F.when(odd, F.array_join(F.transform(parts, finite), "")).otherwise(text)


def is_one_json_value(text: Column) -> Column:
    """Whether the whole text is a single JSON value.

    The parsers stop behind the first value and ignore what follows. Wrapped in an object and in
    an array, only a text that is exactly one value parses both times.
    """
    in_object = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    in_array = F.json_array_length(F.concat(F.lit("["), text, F.lit("]")))
    return in_object.isNotNull() & F.coalesce(in_array == 1, F.lit(False))


def _opened(messages: DataFrame) -> DataFrame:
    """Adds the parsed message with the JSON type and the text of each field."""
    names = [field.name for field in EVENT_FIELDS]
    kinds, texts = (", ".join(f"{name} {kind}" for name in names) for kind in ("VARIANT", "STRING"))
    parsed = messages.withColumn("text", F.try_validate_utf8(F.col("value").cast("string")))
    parsed = parsed.withColumn("finite", with_finite_numbers(F.col("text")))
    return parsed.withColumns(
        {
            "is_json": is_one_json_value(F.col("finite")),
            "is_object": F.col("text").rlike(r"^[ \t\r\n]*\{"),
            "kinds": F.from_json("finite", kinds),
            "texts": F.from_json("text", texts),
        }
    ).select(
        *messages.columns,
        "text",
        "is_json",
        "is_object",
        *(F.schema_of_variant(f"kinds.{n}").alias(f"kind_{n}") for n in names),
        *(F.col(f"texts.{n}").alias(f"text_{n}") for n in names),
    )


def _typed(field: T.StructField) -> Column:
    """The field if its JSON type fits, else NULL: "4" is no number, 4.0 no integer."""
    name, kind = field.name, _kind(field.name)
    if isinstance(field.dataType, T.TimestampType):
        return F.col(f"at_{name}")
    if isinstance(field.dataType, T.StringType):
        return _text(name)
    # A JSON boolean counts as the number 0 or 1.
    value = F.when(kind == "BOOLEAN", (F.col(f"text_{name}") == "true").cast("int").cast("string"))
    if isinstance(field.dataType, T.IntegerType):
        number, target = kind == "BIGINT", "int"
    else:
        number, target = kind.startswith("DECIMAL") | kind.isin("BIGINT", "DOUBLE", "FLOAT"), "double"
    # The reader puts numbers that are not finite in quotes.
    text = F.btrim(F.col(f"text_{name}"), F.lit('"'))
    return F.coalesce(value, F.when(number, text)).try_cast(target)


def _verdict() -> Column:
    """(type, reason) of the first rule the message breaks, NULL for a valid message."""
    def broken(error_type: str, reason: Column | str) -> Column:
        text = F.lit(reason) if isinstance(reason, str) else reason
        return F.struct(F.lit(error_type).alias("type"), text.alias("reason"))

    missing = F.concat_ws(
        ", ",
        *(
            F.when(~F.coalesce(_text(name).rlike(r"\S"), F.lit(False)), F.lit(name))
            for name in REQUIRED_FIELDS
        ),
    )
    verdict = (
        F.when(F.col("value").isNull(), broken("ValueError", NO_VALUE))
        .when(F.col("text").isNull(), broken("UnicodeDecodeError", NOT_UTF8))
        .when(~F.col("is_json"), broken("JSONDecodeError", NOT_JSON))
        .when(~F.col("is_object"), broken("TypeError", NOT_OBJECT))
        .when(missing != "", broken("ValueError", F.concat(F.lit(MISSING_FIELDS), missing)))
        .when(F.col("at_ingested_at").isNull(), broken("ValueError", BAD_INGESTED_AT))
        .when(~has_iso_offset(_text("ingested_at")), broken("ValueError", NAIVE_INGESTED_AT))
    )
    for name in ("feed_timestamp", "vehicle_timestamp"):
        unreadable = _text(name).isNotNull() & F.col(f"at_{name}").isNull()
        reason = F.concat(F.lit(f"{BAD_TIMESTAMP}'"), _text(name), F.lit("'"))
        verdict = verdict.when(unreadable, broken("ValueError", reason))
    return verdict


def decode_events(messages: DataFrame) -> DataFrame:
    """Adds ``record`` (typed event) or ``error_type`` and ``error_reason`` to every message.

    Row-wise and without Python, so it runs the same on a batch and on a stream. As permissive readers
    do, it takes ``NaN`` and infinities for numbers and the last of repeated names; the latter needs
    ``spark.sql.variant.allowDuplicateKeys``, which ``build_session`` sets.
    """
    times = [f.name for f in EVENT_FIELDS if isinstance(f.dataType, T.TimestampType)]
    judged = (
        _opened(messages)
        .withColumns({f"at_{name}": parse_iso(_text(name)) for name in times})
        .withColumn("verdict", _verdict())
    )
    is_event = F.col("is_json") & F.col("is_object")
    record = F.struct(*(_typed(field).alias(field.name) for field in EVENT_FIELDS))
    decoded = F.struct(
        F.when(F.col("verdict").isNull(), record).alias("record"),
        F.col("verdict.type").alias("error_type"),
        F.col("verdict.reason").alias("error_reason"),
        *(
            F.when(is_event, F.nullif(_text(name), F.lit(""))).alias(f"context_{name}")
            for name in ("event_id", "vehicle_id", "trip_id")
        ),
    )
    # A filter on the verdict would be pushed below and repeat the parsing in its condition;
    # it cannot pass an explode.
    return judged.select(*messages.columns, F.explode(F.array(decoded)).alias("decoded")).select(
        *messages.columns, "decoded.*"
    )


def valid_records(decoded: DataFrame, *more: str) -> DataFrame:
    """Typed events with the place in the topic they came from, and ``more`` columns."""
    return decoded.filter("error_type is null").select("topic", "partition", "offset", "record.*", *more)


def dead_letters(decoded: DataFrame, processed_at: Column, *more: str) -> DataFrame:
    """Rejected messages with their raw bytes, whatever ids could be read, and ``more`` columns."""
    return decoded.filter("error_type is not null").select(
        F.col("context_event_id").alias("original_event_id"),
        "topic",
        "partition",
        F.col("offset").alias("kafka_offset"),
        processed_at.alias("processed_at"),
        "error_type",
        "error_reason",
        F.coalesce("value", F.lit(b"")).alias("raw_payload"),
        F.col("context_vehicle_id").alias("vehicle_id"),
        F.col("context_trip_id").alias("trip_id"),
        *more,
    )
