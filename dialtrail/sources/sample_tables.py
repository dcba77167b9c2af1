"""The two base tables derived from the sample star schema.

``orders`` gives the main call log: every kind of status, few ties, leads that
were never called and leads whose calls all failed. ``events`` gives one with
dates cut to the day, so that ties are common. The shared pair has what those
lack: leads that share a phone, missing phones and dates, numbers that belong
to no lead, and one phone with a third of all calls.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dialtrail.schema import CALL_HISTORY, LEAD_BANK
from dialtrail.sources.tables import conform


# The columns read, with their stored types: no schema inference job.
STORED = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string",
}


def _stored(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(STORED[table]).parquet(f"{sf_dir}/{table}.parquet")


def _phone(key: str) -> Column:
    return F.expr(f"concat('9', lpad(CAST({key} AS STRING), 9, '0'))")


def _lookup(value: str, table: dict) -> Column:
    """The text ``table`` gives for a value; null for any other value."""
    cases = " ".join(f"WHEN {key!r} THEN {text!r}" for key, text in table.items())
    return F.expr(f"CASE {value} {cases} END")


def sample_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _leads(spark, sf_dir, _phone("c_custkey"))


def dated_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leads with upload dates in many forms."""
    leads = sample_leads(spark, sf_dir)
    year, month, day = (
        F.substring("uploaded_date", start, size) for start, size in ((1, 4), (6, 2), (9, 2))
    )
    name = F.element_at(F.array(*map(F.lit, MONTH_NAMES)), F.try_to_number(month, F.lit("99")).cast("int"))
    forms = [
        F.col("uploaded_date"),
        F.concat(year, F.lit("/"), month, F.lit("/"), day),
        F.concat(month, F.lit("/"), day, F.lit("/"), year),
        F.concat(day, F.lit("/"), month, F.lit("/"), year),
        F.concat(year, month, day),
        F.concat(day, F.lit(" "), F.substring(name, 1, 3), F.lit(" "), year),
        F.concat(name, F.lit(" "), day, F.lit(", "), year),
        F.concat(year, F.lit("-"), month, F.lit("-"), day, F.lit(" 10:00 AM")),
    ]
    number = F.substring("lead_id", 2, 8).cast("int") % len(forms)
    spelled = F.col("uploaded_date")
    for i, form in enumerate(forms):
        spelled = F.when(number == i, form).otherwise(spelled)
    known = F.col("uploaded_date").startswith("2")
    return leads.withColumn(
        "uploaded_date", F.when(known, spelled).otherwise(F.col("uploaded_date"))
    )


def order_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order keys with numbers that may be missing, infinite or not a number."""
    key = F.col("o_orderkey")
    value = (
        F.when(key % 7 == 0, float("inf"))
        .when(key % 7 == 1, float("-inf"))
        .when(key % 7 == 2, float("nan"))
        .when(key % 7 != 3, (key % 1000) / 4)
    )
    return _stored(spark, sf_dir, "orders").select("o_orderkey", value.alias("price"))


def shared_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    phone = (
        F.when(key % 50 == 9, None)
        .when(key % 10 == 5, _phone("c_custkey - 1"))
        .otherwise(_phone("c_custkey"))
    )
    return _leads(spark, sf_dir, phone)


def _leads(spark, sf_dir, phone):
    customer = _stored(spark, sf_dir, "customer")
    nation = _stored(spark, sf_dir, "nation")
    key = F.col("c_custkey")
    upload_day = F.date_add(F.lit("2024-01-01").cast("date"), (key % 365).cast("int"))
    uploaded = (
        F.when(key % 97 == 5, "not a date")
        .when(key % 89 == 5, None)
        .otherwise(F.concat(upload_day.cast("string"), F.lit(" 10:30:00")))
    )
    leads = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return conform(
        leads.select(
            F.concat(F.lit("L"), F.lpad(key.cast("string"), 8, "0")).alias("lead_id"),
            phone.alias("phone"),
            F.col("c_name").alias("name"),
            uploaded.alias("uploaded_date"),
            F.col("c_mktsegment").alias("source"),
            F.col("n_name").alias("city"),
        ),
        LEAD_BANK,
    )


MONTH_NAMES = (
    "January February March April May June July August September October November December"
).split()

CAMPAIGN_BY_PRIORITY = {
    "1-URGENT": "SALES_OUTBND",
    "2-HIGH": "CARE_INB",
    "3-MEDIUM": "RETBND",
    "5-LOW": "MANUAL",
}

STATUS_BY_ORDERKEY_MOD_16 = {
    0: "DROP",
    1: "PDROP",
    2: "AFTHRS",
    3: "TIMEOT",
    4: "NSO",
    5: "FOLLOW",
    6: "INTVDC",
    7: "WTHINK",
    8: "ISULOC",
    9: "WWCOMP",
    10: "DPSD",
    11: "NEWLEAD",
    12: "AWC",
    13: "",
    14: "ZZUNK",
}


def sample_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _stored(spark, sf_dir, "orders")
    order, customer = F.col("o_orderkey"), F.col("o_custkey")
    dialstatus = (
        F.when(customer % 10 == 7, "FAILED")
        .when(order % 11 == 0, None)
        .when(order % 7 == 0, "CHANUNAVAIL")
        .when(order % 13 == 0, "PROVIDER_FAILURE")
        .otherwise("ANSWER")
    )
    # Customers whose key ends in 3 ring the next one's number: their own leads
    # are never called.
    dialled = _phone("o_custkey + if(o_custkey % 10 = 3, 1, 0)")
    return conform(
        orders.select(
            dialled.alias("phone_number_dialed"),
            F.col("o_orderdate").alias("call_date"),
            _lookup("o_orderpriority", CAMPAIGN_BY_PRIORITY).alias("campaign_id"),
            _lookup("o_orderkey % 16", STATUS_BY_ORDERKEY_MOD_16).alias("status"),
            dialstatus.alias("dialstatus"),
        ),
        CALL_HISTORY,
    )


def cased_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phones that begin with letters. Some leads share the phone of the one
    before, spelt otherwise."""
    key = F.col("c_custkey")
    shared = F.concat(F.lit("Tel"), _phone("c_custkey - 1"))
    phone = F.when(key % 50 == 7, shared).otherwise(F.concat(F.lit("TEL"), _phone("c_custkey")))
    return _leads(spark, sf_dir, phone)


def cased_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts in capitals, small letters and both; one status never in capitals."""
    calls = sample_calls(spark, sf_dir)
    turn = F.dayofyear("call_date")

    def spelt(name, by):
        text = F.when(turn % by == 0, F.lower(name)).when(turn % by == 1, F.initcap(name))
        return F.coalesce(text, F.col(name))

    never = F.col("status") == "ZZUNK"
    return conform(
        calls.withColumns(
            {
                "phone_number_dialed": F.concat(
                    F.when(turn % 2 == 0, "tel").otherwise("TEL"), "phone_number_dialed"
                ),
                "status": F.when(never & (turn % 3 > 0), F.initcap("status"))
                .when(never, F.lower("status"))
                .otherwise(spelt("status", 3)),
                "campaign_id": spelt("campaign_id", 4),
                "dialstatus": spelt("dialstatus", 5),
            }
        ),
        CALL_HISTORY,
    )


def padded_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with up to two spaces behind the texts."""
    calls = cased_calls(spark, sf_dir)
    spaces = F.repeat(F.lit(" "), F.month("call_date") % 3)
    names = [f.name for f in CALL_HISTORY.fields if f.name != "call_date"]
    return conform(calls.withColumns({c: F.concat(c, spaces) for c in names}), CALL_HISTORY)


def accented_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statuses with letters of two and three bytes."""
    calls = sample_calls(spark, sf_dir)
    return calls.withColumn("status", F.concat(F.lit("Ü"), "status", F.lit("€")))


CAMPAIGN_BY_EVENT_MOD_4 = {0: "SALES_OUTBND", 1: "CARE_INB", 2: "RETBND"}

STATUS_BY_EVENT_TYPE = {
    "click": "FOLLOW",
    "error": "DROP",
    "purchase": "DPSD",
    "signup": "NEWLEAD",
}


def sample_calls_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _stored(spark, sf_dir, "events")
    event = F.col("event_id")
    dialstatus = (
        F.when(event % 11 == 0, None)
        .when(event % 7 == 0, "NUMBER_FAILURE")
        .otherwise("ANSWER")
    )
    return conform(
        events.select(
            _phone("user_id").alias("phone_number_dialed"),
            F.col("ts").cast("date").alias("call_date"),
            _lookup("event_id % 4", CAMPAIGN_BY_EVENT_MOD_4).alias("campaign_id"),
            _lookup("event_type", STATUS_BY_EVENT_TYPE).alias("status"),
            dialstatus.alias("dialstatus"),
        ),
        CALL_HISTORY,
    )


def shared_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _stored(spark, sf_dir, "orders")
    order = F.col("o_orderkey")
    phone = (
        F.when(order % 50 == 1, None)
        .when(order % 40 == 2, F.concat(F.lit("8"), _phone("o_custkey")))
        .when(order % 3 == 0, _phone("4"))
        .otherwise(_phone("o_custkey"))
    )
    month = F.date_trunc("month", F.col("o_orderdate")).cast("date")
    dialstatus = (
        F.when(F.col("o_custkey") % 10 == 7, "ATTEMPT_FAILED")
        .when(order % 11 == 0, None)
        .when(order % 7 == 0, "PROVIDER_TEMP_FAILURE")
        .otherwise("ANSWER")
    )
    return conform(
        orders.select(
            phone.alias("phone_number_dialed"),
            F.when(order % 45 != 7, month).alias("call_date"),
            _lookup("o_orderpriority", CAMPAIGN_BY_PRIORITY).alias("campaign_id"),
            _lookup("o_orderkey % 16", STATUS_BY_ORDERKEY_MOD_16).alias("status"),
            dialstatus.alias("dialstatus"),
        ),
        CALL_HISTORY,
    )
