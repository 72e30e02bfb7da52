"""Column lists, fixed values and contracts of the layer tables."""

from __future__ import annotations

# The eight columns of a source line, as bronze names them (all text).
SOURCE_COLUMNS = (
    "invoice",
    "stock_code",
    "description",
    "quantity",
    "invoice_date",
    "unit_price",
    "customer_id",
    "country",
)

# Header spellings of the source files, lower-cased, to bronze names.
HEADER_NAMES = {
    "invoiceno": "invoice",
    "stockcode": "stock_code",
    "description": "description",
    "quantity": "quantity",
    "invoicedate": "invoice_date",
    "unitprice": "unit_price",
    "customerid": "customer_id",
    "customer id": "customer_id",
    "country": "country",
}

LINEAGE_COLUMNS = (
    "source_file_name",
    "source_file_path",
    "load_timestamp",
    "load_batch_id",
    "record_hash",
    "source_block",
    "source_row",
)

# A bronze or silver line's place among all lines: its load, then its file, then where it stands there.
LINE_ORDER = ("load_timestamp", "load_batch_id", "source_file_path", "source_block", "source_row", "bronze_id")

# Texts that mean "missing" once a file has been turned into text.
NULL_TOKENS = ("nan", "None", "NaN", "")

# Accepted quantity span of a clean line.
QUANTITY_BOUNDS = (-10000, 10000)

# Customer bands.
FREQUENCY_BANDS = ((10, "Frequent"), (5, "Regular"), (2, "Occasional"))
FREQUENCY_OTHER = "One-time"
VALUE_BANDS = ((5000, "VIP"), (2000, "High-Value"), (500, "Medium-Value"))
VALUE_OTHER = "Low-Value"
RECENCY_BANDS = ((90, "Active"), (180, "Lapsing"), (365, "Dormant"))
RECENCY_OTHER = "Churned"

# Product categories, first match wins.
CATEGORY_RULES = (
    ("Seasonal - Christmas", ("CHRISTMAS", "XMAS")),
    ("Seasonal - Birthday", ("BIRTHDAY",)),
    ("Bags & Accessories", ("BAG", "TOTE")),
    ("Romantic & Gifts", ("HEART", "LOVE")),
    ("Vintage Collection", ("VINTAGE", "RETRO")),
    ("Kitchen & Dining", ("LUNCH", "KITCHEN", "PLATE")),
)
CATEGORY_MISSING = "Uncategorized - Missing Description"
CATEGORY_OTHER = "General Merchandise"
UNKNOWN_PRODUCT = "UNKNOWN PRODUCT"

# Product revenue tiers; a product above zero but below the last bound is "Low".
TIER_BANDS = ((10000, "Star Product"), (5000, "High Performer"), (1000, "Average Performer"))
TIER_LOW = "Low Performer"
TIER_NONE = "No Sales"

# States of an ingestion batch.
BATCH_STATES = ("STARTED", "SUCCESS", "FAILED", "RUNNING")

GEOGRAPHY_ATTRIBUTES = (
    ("country_code", "string"),
    ("region", "string"),
    ("sub_region", "string"),
    ("continent", "string"),
    ("is_eu_member", "boolean"),
    ("currency_code", "string"),
    ("timezone", "string"),
)
