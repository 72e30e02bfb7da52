import hashlib
from decimal import Decimal

from pyspark.sql import functions as F

from tallyhouse.functions import (
    cents_to_dollars,
    day_of_week,
    iso_week,
    keyword_label,
    record_hash,
    row_digest,
    row_fingerprint,
    safe_divide,
    surrogate_key,
)
from tallyhouse.schemas import CATEGORY_MISSING, CATEGORY_OTHER, CATEGORY_RULES


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_safe_divide(spark):
    lit = F.lit
    found = one(
        spark,
        safe_divide(lit(6), lit(4)),
        safe_divide(lit(6), lit(0)),
        safe_divide(lit(6), lit(None).cast("int"), -1),
        safe_divide(lit(None).cast("int"), lit(2)),
    )
    assert found == (1.5, 0.0, -1.0, None)


def test_cents_to_dollars(spark):
    assert one(spark, cents_to_dollars(F.lit(12345)), cents_to_dollars(F.lit(12345), 1)) == (
        Decimal("123.45"),
        Decimal("123.5"),
    )


def test_surrogate_key(spark):
    token = "_dbt_utils_surrogate_key_null_"
    expected = [hashlib.md5(t.encode()).hexdigest() for t in ("17841.0", f"a-{token}", token)]
    null = F.lit(None).cast("string")
    assert list(one(spark, surrogate_key(F.lit("17841.0")), surrogate_key(F.lit("a"), null), surrogate_key(null))) == expected


def test_record_hash_counts_missing_as_text(spark):
    found = one(spark, record_hash([F.lit("536365"), F.lit(None).cast("string"), F.lit("6")]))[0]
    assert found == hashlib.md5(b"536365|nan|6").hexdigest()


def test_digests_tell_shifted_nulls_apart(spark):
    a, null = F.lit("a"), F.lit(None).cast("string")
    assert len(set(one(spark, row_digest([a, null]), row_digest([null, a]), row_digest([F.lit("a,~"), null])))) == 3
    first, second = one(spark, *row_fingerprint([a, null])), one(spark, *row_fingerprint([null, a]))
    assert first[0] != second[0] and first[1] != second[1]


def test_calendar_parts(spark):
    day = F.to_date(F.lit("2011-01-02"))  # a Sunday, in the last ISO week of 2010
    assert one(spark, day_of_week(day), iso_week(day)) == (0, "2010-52")


def test_first_matching_category_wins(spark):
    texts = {
        "xmas heart bag": "Seasonal - Christmas",
        "Red LOVE tote": "Bags & Accessories",
        "retro plate": "Vintage Collection",
        "plain": CATEGORY_OTHER,
        "": CATEGORY_MISSING,
        None: CATEGORY_MISSING,
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    label = keyword_label("t", CATEGORY_RULES, CATEGORY_MISSING, CATEGORY_OTHER)
    assert {r.t: r.c for r in df.select("t", label.alias("c")).collect()} == texts
