"""Column expressions that turn raw values into what riders and operators read."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from railweave.functions.gtfs_time import AGENCY_ZONE

# Results are compared with these texts, colours and rules.
UNKNOWN = "Unknown"
BLANK_WORDS = ("none", "nan", "unavailable")
STATUS_LABELS = {
    "IN_TRANSIT_TO": "In transit",
    "INCOMING_AT": "Approaching stop",
    "STOPPED_AT": "Stopped",
}
ROUTE_PALETTE = (
    (230, 57, 70),
    (42, 157, 143),
    (244, 162, 97),
    (69, 123, 157),
    (239, 71, 111),
    (118, 104, 175),
    (38, 166, 154),
    (241, 143, 1),
)
FAMILY_COLORS = {
    "RED": (218, 41, 28),
    "ORANGE": (237, 139, 0),
    "BLUE": (0, 61, 165),
    "GREEN": (0, 132, 61),
    "SILVER": (124, 135, 142),
    "COMMUTER_RAIL": (128, 0, 128),
    "FERRY": (0, 142, 170),
    "BUS": (255, 199, 44),
}
UNKNOWN_COLOR = (120, 120, 120, 210)
KNOWN_ALPHA = 220
BYTE_UNITS = ("B", "KiB", "MiB", "GiB", "TiB")
WHITESPACE = " \t\n\r\f\x0b"


def present_text(value: Column) -> Column:
    """Trimmed text, or NULL when it carries no information."""
    text = F.btrim(value.cast("string"), F.lit(WHITESPACE))
    return F.when((text != "") & ~F.lower(text).isin(*BLANK_WORDS), text)


def friendly_value(*values: Column) -> Column:
    """First informative value, else "Unknown"."""
    return F.coalesce(*(present_text(v) for v in values), F.lit(UNKNOWN))


def route_label(short: Column, long: Column, route_id: Column) -> Column:
    """"short - long"; one name when both are the same word; the id when neither is known."""
    short_text, long_text = present_text(short), present_text(long)
    # A name that literally reads "Unknown" counts as missing when the two are combined.
    both = (short_text != UNKNOWN) & (long_text != UNKNOWN)
    same = F.lower(short_text) == F.lower(long_text)
    return (
        F.when(both & same, short_text)
        .when(both, F.concat_ws(" - ", short_text, long_text))
        .otherwise(friendly_value(short, long, route_id))
    )


def title_case(text: Column) -> Column:
    """Capital after every character that is not a letter, small letters elsewhere."""
    # initcap starts a word only after a space, so mark one behind every non-letter.
    marked = F.regexp_replace(F.lower(text), r"([^\p{L}])", "$1\u0001 ")
    return F.replace(F.initcap(marked), F.lit("\u0001 "), F.lit(""))


def friendly_status(status: Column) -> Column:
    text = friendly_value(status)
    label = reduce(
        lambda chain, item: chain.when(text == item[0], F.lit(item[1])),
        STATUS_LABELS.items(),
        F.when(text == UNKNOWN, text),
    )
    return label.otherwise(title_case(F.replace(text, F.lit("_"), F.lit(" "))))


def format_timestamp(ts: Column, include_date: bool = True, zone: str = AGENCY_ZONE) -> Column:
    """Local wall-clock text such as ``Aug 30, 12:00:00 PM EDT``.

    The session zone must be UTC (``build_session`` sets it). The zone abbreviation is derived
    from the offset, which is one hour smaller in summer.
    """
    local = F.from_utc_timestamp(ts, zone)
    offset_hours = (F.unix_seconds(local) - F.unix_seconds(ts)) / 3600
    abbreviation = F.when(offset_hours == -4, "EDT").otherwise("EST")
    pattern = "MMM dd, hh:mm:ss a" if include_date else "hh:mm:ss a"
    text = F.concat_ws(" ", F.date_format(local, pattern), abbreviation)
    return F.when(ts.isNull(), F.lit(UNKNOWN)).otherwise(text)


def _rgba(rgb: tuple[int, ...], alpha: int = KNOWN_ALPHA) -> Column:
    return F.array(*(F.lit(part) for part in (*rgb[:3], alpha)))


def route_marker_color(route_id: Column) -> Column:
    """``[r, g, b, alpha]`` by route family; other routes take a palette slot by checksum."""
    key = friendly_value(route_id)
    upper = F.upper(key)
    starts = upper.startswith
    palette = F.array(*(_rgba(rgb) for rgb in ROUTE_PALETTE))
    slot = (F.crc32(key.cast("binary")) % len(ROUTE_PALETTE)).cast("int")
    return (
        F.when(key == UNKNOWN, _rgba(UNKNOWN_COLOR, UNKNOWN_COLOR[3]))
        .when(starts("RED") | starts("MATTAPAN"), _rgba(FAMILY_COLORS["RED"]))
        .when(starts("ORANGE"), _rgba(FAMILY_COLORS["ORANGE"]))
        .when(starts("BLUE"), _rgba(FAMILY_COLORS["BLUE"]))
        .when(starts("GREEN"), _rgba(FAMILY_COLORS["GREEN"]))
        .when(starts("SL"), _rgba(FAMILY_COLORS["SILVER"]))
        .when(starts("CR-"), _rgba(FAMILY_COLORS["COMMUTER_RAIL"]))
        .when(upper.contains("FERRY") | starts("BOAT"), _rgba(FAMILY_COLORS["FERRY"]))
        .when(upper.rlike("^[0-9]"), _rgba(FAMILY_COLORS["BUS"]))
        .otherwise(F.get(palette, slot))
    )


def color_hex(rgba: Column) -> Column:
    return F.format_string("#%02x%02x%02x", *(F.get(rgba, F.lit(i)) for i in range(3)))


def _fixed(value: Column, digits: int) -> Column:
    """Decimal with ``digits`` places, rounded on the exact binary value with ties to even.

    The nearest 1024th below is taken off first, without loss. What is left is small enough that
    its digits tell a true tie such as 1.25 from 1.95, whose binary value lies below it.
    """
    number = value.cast("double")
    steps = F.floor(number * 1024)
    rest = (number - steps / 1024.0).cast("decimal(38,25)")
    exact = steps.cast("decimal(18,0)") * F.lit(Decimal("0.0009765625"))
    return F.bround((exact + rest).cast("decimal(38,20)"), digits).cast(f"decimal(30,{digits})")


def format_age(seconds: Column) -> Column:
    short = F.concat(_fixed(seconds, 0).cast("string"), F.lit(" seconds"))
    long = F.concat(_fixed(seconds / 60, 1).cast("string"), F.lit(" minutes"))
    return F.when(seconds.isNull(), F.lit(UNKNOWN)).when(seconds < 60, short).otherwise(long)


def format_count(value: Column, missing: str = "Unavailable") -> Column:
    return F.coalesce(F.format_number(value.cast("long"), 0), F.lit(missing))


def format_decimal(value: Column, suffix: str = "", missing: str = "Unavailable") -> Column:
    text = F.concat(F.format_number(_fixed(value, 2), 2), F.lit(suffix))
    return F.coalesce(text, F.lit(missing))


def format_seconds(value: Column) -> Column:
    return F.coalesce(F.concat(_fixed(value, 3).cast("string"), F.lit("s")), F.lit("n/a"))


def format_bytes(size: Column) -> Column:
    """Size with one decimal in the largest binary unit that keeps it at 1 or more."""
    value = size.cast("double")
    chain = F
    for power, unit in enumerate(BYTE_UNITS):
        text = F.concat(_fixed(value / float(1024**power), 1).cast("string"), F.lit(f" {unit}"))
        chain = chain.when(value < float(1024 ** (power + 1)), text)
    return chain.otherwise(text)
