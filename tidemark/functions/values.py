"""Text forms of values: single keys, record text, content hashes and row ids.

The text forms follow PostgreSQL's output rules, so that keys and hashes built here equal
the ones a PostgreSQL warehouse would hold for the same rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def double_text(value: Column, fixed_digits: int = 15, keep_point: bool = False) -> Column:
    """Shortest decimal text of a double.

    Exponents from -4 up to ``fixed_digits`` are written out, others as ``1.5e+20``.
    ``keep_point`` writes whole numbers as ``2.0``.
    """
    java = value.cast("string")
    # Java writes magnitudes from 1e-3 up to 1e7, zero, NaN and infinities without exponent.
    short = java if keep_point else F.regexp_replace(java, r"\.0$", "")
    mantissa = F.regexp_replace(F.substring_index(java, "E", 1), r"\.0$", "")
    exponent = F.substring_index(java, "E", -1).try_cast("int")
    written = F.regexp_replace(java.try_cast("decimal(38,20)").cast("string"), r"\.?0+$", "")
    if keep_point:
        written = F.when(F.instr(written, ".") > 0, written).otherwise(F.concat(written, F.lit(".0")))
    digits = F.abs(exponent).cast("string")
    scientific = F.concat(
        mantissa, F.lit("e"), F.when(exponent < 0, "-").otherwise("+"),
        F.when(F.length(digits) < 2, F.lpad(digits, 2, "0")).otherwise(digits),
    )
    return (
        F.when(F.instr(java, "E") == 0, short)
        .when((exponent >= -4) & (exponent < fixed_digits), written)
        .otherwise(scientific)
    )


def value_text(value: Column, dtype: T.DataType) -> Column:
    """Text of one scalar, as used for a single-column business key."""
    if isinstance(dtype, T.DoubleType):
        return double_text(value)
    return value.cast("string")


def record_text(fields: Iterable[tuple[Column, T.DataType]]) -> Column:
    """Unambiguous text of a row: NULL is empty, text is quoted where it needs to be."""
    parts = []
    for value, dtype in fields:
        if isinstance(dtype, T.BooleanType):
            text = F.when(value, "t").otherwise("f")
            parts.append(F.when(value.isNull(), "").otherwise(text))
        elif isinstance(dtype, T.StringType):
            escaped = F.replace(
                F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('""')
            )
            quoted = F.concat(F.lit('"'), escaped, F.lit('"'))
            parts.append(
                F.when(value.isNull(), "")
                .when((value == "") | value.rlike(r'[\s"\\(),]'), quoted)
                .otherwise(value)
            )
        else:
            parts.append(F.coalesce(value_text(value, dtype), F.lit("")))
    return F.concat(F.lit("("), F.concat_ws(",", *parts), F.lit(")"))


def content_hash(fields: Iterable[tuple[Column, T.DataType]]) -> Column:
    return F.md5(record_text(fields))


def uuid_text(*parts: Column) -> Column:
    """UUID-shaped id that depends on the parts only, so every job computes the same one."""
    digest = F.md5(F.concat_ws("|", *parts))
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8), F.substring(digest, 9, 4), F.substring(digest, 13, 4),
        F.substring(digest, 17, 4), F.substring(digest, 21, 12),
    )


# Characters JSON escapes by a letter, by their UTF-16 code.
_SHORT_ESCAPES = {
    "0022": '\\"', "005C": "\\\\", "0008": "\\b", "0009": "\\t", "000A": "\\n", "000C": "\\f",
    "000D": "\\r",
}


def json_string(value: Column) -> Column:
    """JSON string literal in printable ASCII; other characters become ``\\uXXXX``."""
    plain = F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    units = F.regexp_extract_all(F.hex(F.encode(value, "UTF-16BE")), F.lit("(....)"))

    def escaped(unit: Column) -> Column:
        text = F.when(unit.between("0020", "007E"), F.char(F.conv(unit, 16, 10).cast("int")))
        for code, escape in _SHORT_ESCAPES.items():
            text = F.when(unit == code, escape).otherwise(text)
        return F.coalesce(text, F.concat(F.lit("\\u"), F.lower(unit)))

    body = F.when(value.rlike("[^ -~]"), F.array_join(F.transform(units, escaped), "")).otherwise(plain)
    return F.concat(F.lit('"'), body, F.lit('"'))
