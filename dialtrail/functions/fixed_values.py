"""Results are only right if these equal the source system's."""

FAILED_DIAL_STATUSES = [
    "ATTEMPT_FAILED",
    "PROVIDER_FAILURE",
    "FAILED",
    "PROVIDER_TEMP_FAILURE",
    "CHANUNAVAIL",
    "NUMBER_FAILURE",
]

DROP_STATUSES = ["DROP", "PDROP", "AFTHRS", "TIMEOT"]

OUTBOUND_SUFFIX = "BND"
INBOUND_SUFFIX = "INB"

# Call status to stage score. The empty status is a real status.
# Statuses not listed, and null, score 0.
STAGE_SCORES = {
    "NSO": 30,
    "DAP": 30,
    "WRGN": 30,
    "BT": 30,
    "DVNAUD": 30,
    "NAR": 30,
    "DROP": 30,
    "ADCT": 30,
    "PDROP": 30,
    "NA": 30,
    "": 30,
    "FOLLOW": 60,
    "INTVDC": 80,
    "WTHINK": 70,
    "ISULOC": 50,
    "ISUDOC": 50,
    "ISUSD": 50,
    "ISUID": 50,
    "WWCOMP": 40,
    "ISUOS": 40,
    "OISPTW": 40,
    "OWNVAN": 40,
    "ABULRB": 40,
    "NORESN": 40,
    "HND": 40,
    "AWC": 10,
    "DPSD": 100,
    "OPSCC": 10,
    "LANGB": 10,
    "NEWLEAD": 20,
}

UNLISTED_SCORE = 0

LEADS_PER_PAGE = 2_000
ROWS_PER_PUBLISH_BATCH = 100_000
