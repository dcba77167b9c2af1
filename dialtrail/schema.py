"""Logical schemas of the two base tables and of the published report.

Call dates are wall-clock times without a zone (TIMESTAMP_NTZ), so no result
depends on the session time zone. Phones are text: leading zeros matter.
"""

from pyspark.sql import types as T


def _fields(*pairs):
    return T.StructType([T.StructField(name, kind, True) for name, kind in pairs])


LEAD_BANK = _fields(
    ("lead_id", T.StringType()),
    ("phone", T.StringType()),
    ("name", T.StringType()),
    ("uploaded_date", T.StringType()),
    ("source", T.StringType()),
    ("city", T.StringType()),
)

CALL_HISTORY = _fields(
    ("phone_number_dialed", T.StringType()),
    ("call_date", T.TimestampNTZType()),
    ("campaign_id", T.StringType()),
    ("status", T.StringType()),
    ("dialstatus", T.StringType()),
)

# The column names and their order are part of the output contract,
# "last_call_data" included.
LEAD_REPORT = _fields(
    ("lead_id", T.StringType()),
    ("phone", T.StringType()),
    ("name", T.StringType()),
    ("uploaded_date", T.StringType()),
    ("source", T.StringType()),
    ("city", T.StringType()),
    ("first_call_date", T.TimestampNTZType()),
    ("last_call_data", T.TimestampNTZType()),
    ("out_bound_count", T.LongType()),
    ("in_bound_count", T.LongType()),
    ("latest_drop_call_date", T.TimestampNTZType()),
    ("max_out_bound_call_date", T.TimestampNTZType()),
    ("outbound_after_drop", T.StringType()),
    ("max_call_date", T.TimestampNTZType()),
    ("last_call_status", T.StringType()),
    ("max_score", T.IntegerType()),
    ("status_summary", T.StringType()),
)

LEAD_COLUMNS = LEAD_BANK.fieldNames()
REPORT_COLUMNS = LEAD_REPORT.fieldNames()
ACTIVITY_COLUMNS = REPORT_COLUMNS[:13]
