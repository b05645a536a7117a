"""Row schemas of the tables and messages the operators exchange."""

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


# Behaviour event as published to the event topic (JSON value).
BEHAVIOR_MESSAGE = _struct(
    ("eventId", T.StringType()),
    ("userId", T.LongType()),
    ("itemId", T.LongType()),
    ("behaviorType", T.StringType()),
    ("rating", T.DoubleType()),
    ("sessionId", T.StringType()),
    ("deviceInfo", T.StringType()),
    ("timestamp", T.StringType()),
)

# Order event (JSON value). event id arrives as {"value": "..."} or as plain text.
ORDER_MESSAGE = _struct(
    ("eventId", T.StringType()),
    ("orderId", T.StringType()),
    ("userId", T.LongType()),
    ("status", T.StringType()),
    ("amount", T.DecimalType(18, 2)),
    ("currency", T.StringType()),
    ("occurredAt", T.StringType()),
)

# Raw supplier payload message (JSON value).
RAW_PAYLOAD_MESSAGE = _struct(
    ("supplierId", T.LongType()),
    ("supplierCode", T.StringType()),
    ("erpType", T.StringType()),
    ("rawPayload", T.StringType()),
    ("pageToken", T.StringType()),
    ("nextPageToken", T.StringType()),
    ("pulledAt", T.TimestampType()),
    ("recordCount", T.IntegerType()),
)

# Key-value dump row: one of text / fields / items is set, according to ``type``.
KEY_VALUE_DUMP = _struct(
    ("key", T.StringType()),
    ("type", T.StringType()),
    ("text", T.StringType()),
    ("fields", T.MapType(T.StringType(), T.StringType())),
    ("items", T.ArrayType(T.StringType())),
)

NORMALIZED_RECORD_COLUMNS = [
    "supplier_id", "supplier_code", "erp_type", "source_record_id", "source_business_code",
    "supplier_name", "source_supplier_status", "supplier_status", "tax_no", "source_modified_at",
    "page_token", "next_page_token", "pulled_at", "raw_item_json",
]
