"""Column expressions shared by the layers. Everything here stays inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, functions as F

# Text that stands for NULL in a surrogate key and in a record hash.
NULL_KEY_TEXT = "_dbt_utils_surrogate_key_null_"
NULL_HASH_TEXT = "nan"

AUDIT_TIME_COLUMNS = ("loaded_at", "updated_at")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double(c: Column | str) -> Column:
    return _col(c).cast("double")


def safe_divide(numerator: Column | str, denominator: Column | str, default=0) -> Column:
    """Quotient as double; `default` where the denominator is NULL or zero."""
    den = _col(denominator)
    return F.when(den.isNull() | (den == 0), F.lit(default).cast("double")).otherwise(
        as_double(numerator) / den.cast("double")
    )


def cents_to_dollars(cents: Column | str, precision: int = 2) -> Column:
    """Cents as DECIMAL(18, precision) dollars."""
    return (_col(cents).cast("decimal(20,0)") / F.lit(100).cast("decimal(3,0)")).try_cast(
        f"decimal(18,{precision})"
    )


def surrogate_key(*columns: Column | str) -> Column:
    """md5 text over the text forms of `columns`, NULL replaced by a fixed token."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(NULL_KEY_TEXT)) for c in columns]
    return F.md5(F.concat_ws("-", *parts))


def packed_key(key: Column | str) -> Column:
    """A text key in fewer bytes for a shuffle: an md5 text as its 16 bytes, any other as it is.

    A first byte tells the two apart, so two keys are packed alike only if they are equal.
    """
    text = _col(key).cast("string")
    plain = F.concat(F.lit(bytearray(b"\x00")), F.encode(text, "UTF-8"))
    return F.when(text.rlike(r"^[0-9a-f]{32}\z"), F.concat(F.lit(bytearray(b"\x01")), F.unhex(text))).otherwise(plain)


def unpacked_key(packed: Column | str) -> Column:
    """The text that `packed_key` was given."""
    key = _col(packed)
    rest = F.substring(key, 2, 2147483647)
    return F.when(F.substring(key, 1, 1) == F.lit(bytearray(b"\x01")), F.lower(F.hex(rest))).otherwise(F.decode(rest, "UTF-8"))


def record_hash(columns: Iterable[Column | str]) -> Column:
    """md5 text of the source columns joined by a bar; a missing value counts as text."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(NULL_HASH_TEXT)) for c in columns]
    return F.md5(F.concat_ws("|", *parts))


def row_digest(columns: Iterable[Column | str]) -> Column:
    """md5 that two rows share only if every column is equal, NULL equal to NULL.

    Each value carries its length, so no separator inside a value can blur two columns.
    """
    parts = []
    for c in columns:
        text = _col(c).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text), F.lit(":"), text), F.lit("~")))
    return F.md5(F.concat_ws(",", *parts))


def row_fingerprint(columns: Iterable[Column | str]) -> list[Column]:
    """Two 64-bit hashes that stand for a whole row when equal rows are to be counted.

    Fixed width keeps the aggregation in Spark's fast hash map. Which values are NULL is
    hashed too, since a NULL alone leaves a hash unchanged. 128 bits make a false match
    among 10^12 rows less likely than 10^-14.
    """
    values = [_col(c) for c in columns]
    nulls = [v.isNull() for v in values]
    return [
        F.xxhash64(F.lit("first"), *values, *nulls).alias("fingerprint_1"),
        F.xxhash64(F.lit("second"), *nulls, *reversed(values)).alias("fingerprint_2"),
    ]


def null_if_token(c: Column | str, tokens: Sequence[str]) -> Column:
    """NULL where the value is one of the texts that stand for a missing value."""
    value = _col(c)
    return F.when(~value.isin(*tokens), value) if tokens else value


def day_of_week(c: Column | str) -> Column:
    """0 for Sunday to 6 for Saturday."""
    return F.dayofweek(_col(c)) - 1


def iso_week(c: Column | str) -> Column:
    """ISO year and week, such as 2011-07."""
    day = _col(c)
    return F.concat_ws(
        "-",
        F.extract(F.lit("YEAROFWEEK"), day).cast("string"),
        F.lpad(F.weekofyear(day).cast("string"), 2, "0"),
    )


def band_label(
    value: Column | str, bands: Sequence[tuple[float, str]], otherwise: str, *, descending: bool = True
) -> Column:
    """Label of the first band that holds: `value >= bound`, or `<=` when not descending."""
    c = _col(value)
    labelled = None
    for bound, label in bands:
        test = c >= F.lit(bound) if descending else c <= F.lit(bound)
        labelled = F.when(test, label) if labelled is None else labelled.when(test, label)
    return labelled.otherwise(otherwise)


def keyword_label(
    text: Column | str, rules: Sequence[tuple[str, Sequence[str]]], missing: str, otherwise: str
) -> Column:
    """Label of the first rule with a keyword inside the upper-cased text."""
    raw = _col(text)
    upper = F.upper(raw)
    labelled = F.when(raw.isNull() | (raw == ""), missing)
    for label, keywords in rules:
        hit = upper.contains(keywords[0])
        for word in keywords[1:]:
            hit = hit | upper.contains(word)
        labelled = labelled.when(hit, label)
    return labelled.otherwise(otherwise)
