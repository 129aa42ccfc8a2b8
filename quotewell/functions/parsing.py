"""From text to typed values. Unreadable text becomes NULL, never an exception."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def is_filled(text: Column) -> Column:
    """True where the text is neither NULL nor blank."""
    return text.isNotNull() & (F.trim(text) != "")


def parse_date(text: Column) -> Column:
    """`2024-01-15` or day-first `15/01/2024`."""
    text = F.trim(text)
    return F.coalesce(F.try_to_date(text, "yyyy-MM-dd"), F.try_to_date(text, "dd/MM/yyyy"))


def parse_decimal(text: Column, precision: int = 18, scale: int = 4) -> Column:
    """`32.45`, `32,45` or `1.234,50`: where a comma occurs it is the decimal mark and points group thousands."""
    text = F.trim(text)
    plain = F.when(text.contains(","), F.translate(text, ",.", ".")).otherwise(text)
    return plain.try_cast(f"decimal({precision},{scale})")


def parse_integer(text: Column) -> Column:
    """`45230000` or `45.230.000`: points and commas only group thousands."""
    return F.translate(F.trim(text), ".,", "").try_cast("bigint")


def share_type(ticker: Column) -> Column:
    """UNIT for suffix 11, else ON for an odd last digit and PN for an even one."""
    last_digit = F.right(ticker, F.lit(1)).try_cast("int")
    return F.when(ticker.endswith("11"), "UNIT").when(last_digit % 2 == 1, "ON").otherwise("PN")


def is_active(situation: Column) -> Column:
    """Registry situation text to the active flag; unknown situations count as inactive."""
    return F.coalesce(F.upper(F.trim(situation)).startswith("ATIV"), F.lit(False))


def statement_period(kind: Column) -> Column:
    """Filing family to statement type: yearly DFP, quarterly ITR."""
    return F.when(F.upper(kind) == "DFP", "ANUAL").when(F.upper(kind) == "ITR", "TRIMESTRAL")


def whole_currency(value: Column, scale_text: Column, enabled: bool = True) -> Column:
    """Statement values filed in thousands turned into whole currency; with enabled=False as filed."""
    if not enabled:
        return value
    return F.when(F.upper(F.trim(scale_text)) == "MIL", value * 1000).otherwise(value)


def same_text(left: Column, right: Column) -> Column:
    """Equality without regard to case or accents, as in an accent-insensitive collation."""
    return F.collate(left, "UNICODE_CI_AI") == F.collate(right, "UNICODE_CI_AI")


def row_json(*columns: str) -> Column:
    """The row as JSON text with NULL fields kept."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def source_label(prefix: str, code: Column) -> Column:
    """`BCB_` + code; NULL where the code is NULL."""
    return F.concat(F.lit(prefix), code)


def duration_seconds(start: Column, end: Column) -> Column:
    """Whole seconds between two timestamps, NULL while the end is open."""
    return F.timestamp_diff("SECOND", start, end)
