"""ISO-8601 text to instants and back. A text without a zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EXTENDED = (
    r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}([.,]\d+)?)?(Z|[+-]\d{2}:?\d{2})?$"
)
# What a cast reads as it stands; the other rules need several expressions for each value.
_PLAIN = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})\z"
_DATE = r"^\d{4}-\d{2}-\d{2}$"
_BASIC = r"^(\d{4})-?(\d{2})-?(\d{2})[T ]?(\d{2})?:?(\d{2})?:?(\d{2})?([.,]\d+)?(Z|[+-]\d{2}:?\d{2})?$"


def parse_instant(text: Column) -> Column:
    """Timestamp of an ISO-8601 text, NULL when it is not one."""
    zone = F.regexp_extract(text, r"(Z|[+-]\d{2}:?\d{2})$", 1)
    zone = F.when(zone == "", "Z").when(
        F.length(zone) == 5, F.concat(F.left(zone, F.lit(3)), F.lit(":"), F.right(zone, F.lit(2)))
    ).otherwise(zone)
    local = F.replace(
        F.regexp_replace(text, r"(Z|[+-]\d{2}:?\d{2})$", ""), F.lit(","), F.lit(".")
    )
    local = F.when(F.length(local) == len("2026-01-01T11:30"), F.concat(local, F.lit(":00"))).otherwise(local)

    def piece(group: int, default: str | None = None) -> Column:
        part = F.regexp_extract(text, _BASIC, group)
        return F.when(part == "", default).otherwise(part) if default is not None else part

    basic = F.concat(
        piece(1), F.lit("-"), piece(2), F.lit("-"), piece(3), F.lit("T"),
        piece(4, "00"), F.lit(":"), piece(5, "00"), F.lit(":"), piece(6, "00"),
        F.replace(piece(7), F.lit(","), F.lit(".")), zone,
    )
    return (
        F.when(text.rlike(_PLAIN), text.try_cast("timestamp"))
        .when(text.rlike(_EXTENDED), F.concat(local, zone).try_cast("timestamp"))
        .when(text.rlike(_DATE), F.concat(text, F.lit("T00:00:00Z")).try_cast("timestamp"))
        .when(text.rlike(_BASIC), basic.try_cast("timestamp"))
    )


def iso_text(instant: Column, zone: str = "+00:00") -> Column:
    """UTC text of an instant; microseconds are written only when there are any."""
    utc = F.to_utc_timestamp(instant, F.current_timezone())
    micros = F.unix_micros(instant) % 1000000
    return F.concat(
        F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(micros != 0, F.date_format(utc, ".SSSSSS")).otherwise(""),
        F.lit(zone),
    )
