"""Normalising ids, text, dates and numbers with built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The grammar of a Python bytes literal in single quotes and its named escapes.
BYTE_ESCAPE = r"(?s)\\x[0-9A-Fa-f]{2}|\\[\x01-\x77\x79-\x7f]"
BYTE_PLAIN = r"^[\x01-\x09\x0b\x0c\x0e-\x26\x28-\x5b\x5d-\x7f]*$"
BYTE_ALL_HEX = r"b'(?:\\x[0-9A-Fa-f]{2})*+'"
BYTE_TOKEN = r"(?s)\\x[0-9A-Fa-f]{2}|\\[0-7]{1,3}|\\.|[^\\]+"
NAMED_ESCAPES = {
    "\\\\": "5c",
    "\\'": "27",
    '\\"': "22",
    "\\a": "07",
    "\\b": "08",
    "\\f": "0c",
    "\\n": "0a",
    "\\r": "0d",
    "\\t": "09",
    "\\v": "0b",
    "\\\n": "",
}
# Plain decimal numbers. Java would also accept suffixes such as "12d".
INTEGER_TEXT = r"^\s*[+-]?[0-9]+\s*$"
NUMBER_TEXT = r"^\s*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\s*$"
ZONED_TEXT = r"[0-9:.]\s*(?:Z|UTC|[+-][0-9]{2}:?[0-9]{2})\s*$"
SPECIAL_NUMBER_TEXT = r"^\s*(?:nan|[+-]?inf(?:inity)?)\s*$"


def _token_hex(token: Column) -> Column:
    """Hex digits of one piece of a bytes literal: a run of plain characters or one escape."""
    kind = F.substring(token, 2, 1)
    octal = F.lower(F.lpad(F.conv(F.substring(token, 2, 3), 8, 16), 4, "0"))
    out = F.when(~token.startswith("\\"), F.lower(F.hex(token)))
    out = out.when(kind == "x", F.lower(F.substring(token, 3, 2)))
    out = out.when(kind.between("0", "7"), F.right(octal, F.lit(2)))
    for escape, digits in NAMED_ESCAPES.items():
        out = out.when(token == escape, F.lit(digits))
    return out.otherwise(F.lower(F.hex(token)))


def hex_id(c: Column, dtype: T.DataType) -> Column:
    """One comparable text form for an id: bytes and byte literals become lower-case hex.

    Text that is not a well-formed ``b'...'`` literal, and every other type, is kept as text.
    """
    if isinstance(dtype, T.BinaryType):
        return F.lower(F.hex(c))
    if isinstance(dtype, T.StringType):
        body = F.substr(c, F.lit(3), F.length(c) - 3)
        decoded = F.array_join(F.transform(F.regexp_extract_all(body, F.lit(BYTE_TOKEN), F.lit(0)), _token_hex), "")
        quoted = c.startswith("b'") & c.endswith("'") & (F.length(c) > 2)
        # Without its escapes a literal is plain text; a bad escape leaves its backslash behind.
        well_formed = F.regexp_replace(body, BYTE_ESCAPE, "").rlike(BYTE_PLAIN)
        # Most literals are all escapes or have none; only mixed ones are cut into tokens.
        all_hex = quoted & c.rlike(rf"\A{BYTE_ALL_HEX}\z")
        plain = quoted & ~F.contains(body, F.lit("\\")) & body.rlike(BYTE_PLAIN)
        out = F.when(all_hex, F.lower(F.replace(body, F.lit("\\x"), F.lit(""))))
        out = out.when(plain, F.lower(F.hex(body)))
        return out.when(F.when(quoted, well_formed), decoded).otherwise(c)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(c), c.cast("string"))
    return c.cast("string")


def utf8_text(c: Column, dtype: T.DataType) -> Column:
    """Bytes as UTF-8 text, or as Latin-1 where they are not valid UTF-8. Text passes unchanged."""
    if not isinstance(dtype, T.BinaryType):
        return c
    text = c.cast("string")
    return F.when(F.is_valid_utf8(text), text).otherwise(F.decode(c, "ISO-8859-1"))


def naive_timestamp(c: Column, dtype: T.DataType, formats: tuple[str, ...] = ()) -> Column:
    """A timestamp, with junk turned into null. Each row is parsed on its own.

    Timestamps pass unchanged. Numbers are nanoseconds since 1970. Text is read as ISO first, then by
    each of ``formats``; a time with a zone is converted to UTC. Types that cannot be dates raise.
    """
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return c
    if isinstance(dtype, T.DateType):
        return c.cast("timestamp_ntz")
    if isinstance(dtype, T.NumericType):
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        whole = known(c, dtype).cast("bigint")
        # Exact: a quotient as a double would round the microseconds.
        micros = ((whole - F.pmod(whole, F.lit(1000))) / F.lit(1000)).cast("bigint")
        return F.timestamp_add("MICROSECOND", micros, epoch)
    if isinstance(dtype, T.NullType):
        return F.lit(None).cast("timestamp_ntz")
    if not isinstance(dtype, T.StringType):
        raise TypeError(f"{dtype.simpleString()} cannot be a date")
    zoned = F.convert_timezone(F.current_timezone(), F.lit("UTC"), c.try_cast("timestamp").cast("timestamp_ntz"))
    tries = [F.when(c.rlike(ZONED_TEXT), zoned).otherwise(c.try_cast("timestamp_ntz"))]
    tries += [F.try_to_timestamp(c, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(*tries)


def number(c: Column, dtype: T.DataType) -> Column:
    """A double, with anything that is not a number turned into null."""
    if isinstance(dtype, T.StringType):
        accepted = c.rlike(NUMBER_TEXT) | F.lower(c).rlike(SPECIAL_NUMBER_TEXT)
        value = F.when(accepted, c.try_cast("double"))
    elif isinstance(dtype, (T.NumericType, T.BooleanType)):
        value = c.cast("double")
    else:
        return F.lit(None).cast("double")
    return F.when(~F.isnan(value), value)


def amount(c: Column, dtype: T.DataType) -> Column:
    """A double, with anything that is not a number turned into 0."""
    return F.coalesce(number(c, dtype), F.lit(0.0))


def known(c: Column, dtype: T.DataType) -> Column:
    """The value, with NaN as null."""
    return F.when(~F.isnan(c), c) if isinstance(dtype, (T.DoubleType, T.FloatType)) else c


def _present(df: DataFrame, columns) -> list[str]:
    return [c for c in columns if c in df.columns]


def normalize_ids(df: DataFrame, columns) -> DataFrame:
    """Apply :func:`hex_id` to those of ``columns`` that exist."""
    return df.withColumns({c: hex_id(F.col(c), df.schema[c].dataType) for c in _present(df, columns)})


def normalize_text(df: DataFrame, columns) -> DataFrame:
    """Apply :func:`utf8_text` to those of ``columns`` that exist."""
    return df.withColumns({c: utf8_text(F.col(c), df.schema[c].dataType) for c in _present(df, columns)})


def normalize_dates(df: DataFrame, columns, formats: tuple[str, ...] = ()) -> DataFrame:
    """Apply :func:`naive_timestamp` to those of ``columns`` that exist."""
    return df.withColumns(
        {c: naive_timestamp(F.col(c), df.schema[c].dataType, formats) for c in _present(df, columns)}
    )


def numeric_casts(df: DataFrame, columns) -> dict[str, str]:
    """For each text column whose every value is a number, the type it can be cast to.

    All columns are probed by one aggregate: bigint if all values are integers that fit, double if
    all are numbers. Other columns are left out.
    """
    texts = [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]
    if not texts:
        return {}
    probes = []
    for i, name in enumerate(texts):
        c = F.col(f"`{name}`")
        is_integer = F.when(c.isNotNull(), c.rlike(INTEGER_TEXT) & c.try_cast("bigint").isNotNull())
        is_number = c.rlike(NUMBER_TEXT) | F.lower(c).rlike(SPECIAL_NUMBER_TEXT)
        probes.append(F.coalesce(F.bool_and(is_integer), F.lit(False)).alias(f"i{i}"))
        probes.append(F.coalesce(F.bool_and(is_number), F.lit(True)).alias(f"n{i}"))
    found = df.agg(*probes).first()
    casts = {}
    for i, name in enumerate(texts):
        if found[f"i{i}"]:
            casts[name] = "bigint"
        elif found[f"n{i}"]:
            casts[name] = "double"
    return casts


def numeric_or_keep(df: DataFrame, columns) -> DataFrame:
    """Cast a text column to numbers if every value allows it, else leave the whole column alone."""
    casts = numeric_casts(df, _present(df, columns))
    return df.withColumns({c: F.col(f"`{c}`").cast(t) for c, t in casts.items()})
