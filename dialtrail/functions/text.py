"""Text forms used by the report and by publishing."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
MONTH = (
    "(?i:(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)"
    "(?:uary|ruary|ch|il|e|y|ust|t|tember|ober|ember)?)"
)
TIME = r"(?:[ T]+(?:[01]?\d|2[0-3]):[0-5]\d(?::[0-5]\d(?:\.\d+)?)?(?: *[AaPp][Mm])?)?"
# Forms of a date besides ISO, tried in this order, with the groups that hold its
# year, month and day. 05/03/2024 is the third of May: the month comes first, and
# the day only where that is no date, as in 25/03/2024.
DATE_FORMS = [
    (r"(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})", (1, 2, 3)),
    (r"(\d{4})(\d{2})(\d{2})", (1, 2, 3)),
    (r"(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})", (3, 1, 2)),
    (r"(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})", (3, 2, 1)),
    (rf"(\d{{1,2}})[ -]{MONTH}\.?,?[ -](\d{{4}})", (3, 2, 1)),
    (rf"{MONTH}\.? (\d{{1,2}}),? (\d{{4}})", (3, 1, 2)),
]


def _spelled(name: str, form: str, groups: tuple[int, int, int]) -> Column:
    """The date that a text of this form spells; null for any other text."""
    text, pattern = F.col(name), rf"^\s*{form}{TIME}\s*$"
    year, month, day = (F.regexp_extract(text, pattern, group) for group in groups)
    if MONTH in form:
        # Its three letters begin at 1, 4, 7 and so on.
        month = ((F.position(F.lower(month), F.lit(MONTHS)) + 2) / 3).cast("int").cast("string")
    parts = [F.lpad(year, 4, "0"), F.lpad(month, 2, "0"), F.lpad(day, 2, "0")]
    return F.when(text.rlike(pattern), F.concat_ws("-", *parts).try_cast("date"))


def report_date(name: str) -> Column:
    """Leniently parsed date as dd/MM/yyyy, each value on its own: ISO text,
    else the first of DATE_FORMS that gives a date; null where none does.

    Cut from the ISO text rather than formatted: ``date_format`` goes through
    the session zone, which may lack that very moment.
    """
    iso = F.col(name).try_cast("timestamp_ntz").cast("date")
    found = F.coalesce(iso, *[_spelled(name, *form) for form in DATE_FORMS]).cast("string")
    return F.regexp_replace(found, r"^(\d+)-(\d\d)-(\d\d)$", "$3/$2/$1")


def cell_text(field: T.StructField) -> Column:
    """A value as published: missing, NaN and infinite become the empty string."""
    value = F.col(field.name)
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        finite = ~(F.isnan(value) | (F.abs(value) == float("inf")))
        value = F.when(finite, value)
    return F.coalesce(value.cast("string"), F.lit("")).alias(field.name)
