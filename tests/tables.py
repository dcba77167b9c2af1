"""Small lead and call tables as rows, and the report worked out by loops."""

from datetime import datetime

from dialtrail.functions import fixed_values as V
from dialtrail.schema import CALL_HISTORY, LEAD_BANK


def leads_of(spark, rows):
    return spark.createDataFrame(rows, LEAD_BANK)


def calls_of(spark, rows):
    return spark.createDataFrame(rows, CALL_HISTORY)


def day(number):
    return None if number is None else datetime(2024, 1, number)


def _lead(lead_id, phone, uploaded):
    return (lead_id, phone, None, uploaded, None, None)


GOLDEN_LEADS = [
    _lead("L1", "p1", "2024-03-05 10:00:00"),
    _lead("L2", "p2", "2024-03-06"),
    _lead("L3", "p3", "not a date"),
    _lead("L4", "p4", None),
    _lead("L5", None, "2024-03-07"),
    _lead("L6", "p6", "2024-03-08"),
    _lead("L7", "p7", "2024-03-09"),
    _lead("L8", "p7", "2024-03-09"),
]

GOLDEN_CALLS = [
    (phone, day(number), campaign, status, dial)
    for phone, number, campaign, status, dial in [
        ("p1", 1, "SALES_OUTBND", "NSO", "ANSWER"),
        ("p1", 3, "CARE_INB", "DROP", "ANSWER"),
        ("p1", 4, "SALES_OUTBND", "FOLLOW", "ANSWER"),
        ("p1", 9, "SALES_OUTBND", "DPSD", "FAILED"),
        ("p2", 2, "SALES_OUTBND", "DPSD", "FAILED"),
        ("p4", 5, "CARE_INB", "DROP", "ANSWER"),
        ("p4", 5, "SALES_OUTBND", "NA", "ANSWER"),
        ("p6", 6, "CARE_INB", "FOLLOW", None),
        ("p7", 7, "SALES_OUTBND", None, "ANSWER"),
        ("p7", 8, "SALES_OUTBND", "", "ANSWER"),
        ("p9", 9, "SALES_OUTBND", "NSO", "ANSWER"),
        (None, 10, "SALES_OUTBND", "NSO", "ANSWER"),
    ]
]


def _golden(lead_id, phone, uploaded, *rest):
    first, last, out, inb, drop, max_out, back, newest, status, score, text = rest
    return (
        (lead_id, phone, None, uploaded, None, None, day(first), day(last), out, inb)
        + (day(drop), day(max_out), back, day(newest), status, score, text)
    )


P1_TEXT = "DROP(1), FOLLOW(1), NSO(1)"
P4 = (5, 5, 1, 1, 5, 5, "no", 5)
P7 = _golden("L7", "p7", "09/03/2024", 7, 8, 4, 0, None, 8, "no", 8, "", 30, "(2), (2)")
NONE_CALLED = (None, None, 0, 0, None, None, "no", None, None)

GOLDEN_REPORT = [
    _golden("L1", "p1", "05/03/2024", 1, 4, 2, 1, 3, 4, "yes", 4, "FOLLOW", 60, P1_TEXT),
    _golden("L2", "p2", "06/03/2024", *NONE_CALLED, None, None),
    _golden("L3", "p3", None, *NONE_CALLED, 0, None),
    _golden("L4", "p4", None, *P4, "DROP", 30, "DROP(1), NA(1)"),
    _golden("L4", "p4", None, *P4, "NA", 30, "DROP(1), NA(1)"),
    _golden("L5", None, "07/03/2024", *NONE_CALLED, 0, None),
    _golden("L6", "p6", "08/03/2024", 6, 6, 0, 1, None, None, "no", None, None, 60, None),
    P7,
    P7,
]


def _highest(values):
    return max((value for value in values if value is not None), default=None)


def looped_report(leads, calls):
    """Nested loops over the joined rows, one phone at a time."""
    report = []
    for phone in {lead[1] for lead in leads}:
        owners = sorted(lead for lead in leads if lead[1] == phone)
        mine = [c for c in calls if phone is not None and c[0] == phone] * len(owners)
        alive = [c for c in mine if c[4] not in V.FAILED_DIAL_STATUSES]
        linked = [c for c in alive if c[4] is not None]

        def ends(call, suffix):
            return call[2] is not None and call[2].endswith(suffix)

        outbound = [c for c in alive if ends(c, "BND")]
        dates = [c[1] for c in alive if c[1] is not None]
        drop = _highest(c[1] for c in alive if c[3] in V.DROP_STATUSES)
        back = _highest(c[1] for c in outbound)
        later = drop is not None and back is not None and back > drop
        scores = [V.STAGE_SCORES.get(c[3], 0) for c in alive]
        score = max(scores, default=None) if mine else 0
        statuses = sorted({c[3] for c in linked} - {None})
        counts = [f"{s}({sum(c[3] == s for c in linked)})" for s in statuses]
        items = [item for item in counts for _ in owners]
        newest = _highest(c[1] for c in linked)
        ties = [(c[1], c[3]) for c in linked if newest is not None and c[1] == newest]
        for newest_date, status in ties or [(None, None)]:
            report.append(
                owners[0]
                + (min(dates, default=None), max(dates, default=None))
                + (len(outbound), sum(ends(c, "INB") for c in alive), drop, back)
                + ("yes" if later else "no", newest_date, status, score)
                + (", ".join(items) or None,)
            )
    return report
