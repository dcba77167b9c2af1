"""ANSI SQL for DuckDB: the plain join-then-aggregate reading of each query."""

import re

from dialtrail.registry.named import OPERATORS
from dialtrail.schema import REPORT_COLUMNS


def _leads(phone):
    return f"""
  select concat('L', lpad(cast(c_custkey as varchar), 8, '0')) as lead_id,
         {phone} as phone,
         c_name as name,
         case when c_custkey % 97 = 5 then 'not a date'
              when c_custkey % 89 = 5 then null
              else concat(cast(date '2024-01-01' + cast(c_custkey % 365 as int) as varchar),
                          ' 10:30:00')
         end as uploaded_date,
         c_mktsegment as source,
         n_name as city
  from customer left join nation on n_nationkey = c_nationkey"""


def _phone(key):
    return f"concat('9', lpad(cast({key} as varchar), 9, '0'))"


CAMPAIGN = """case o_orderpriority
           when '1-URGENT' then 'SALES_OUTBND' when '2-HIGH' then 'CARE_INB'
           when '3-MEDIUM' then 'RETBND' when '5-LOW' then 'MANUAL' end"""

STATUS = """case o_orderkey % 16
           when 0 then 'DROP' when 1 then 'PDROP' when 2 then 'AFTHRS'
           when 3 then 'TIMEOT' when 4 then 'NSO' when 5 then 'FOLLOW'
           when 6 then 'INTVDC' when 7 then 'WTHINK' when 8 then 'ISULOC'
           when 9 then 'WWCOMP' when 10 then 'DPSD' when 11 then 'NEWLEAD'
           when 12 then 'AWC' when 13 then '' when 14 then 'ZZUNK' end"""

ORDERS_CALLS = f"""
  select {_phone("(o_custkey + case when o_custkey % 10 = 3 then 1 else 0 end)")}
           as phone_number_dialed,
         o_orderdate as call_date,
         {CAMPAIGN} as campaign_id,
         {STATUS} as status,
         case when o_custkey % 10 = 7 then 'FAILED'
              when o_orderkey % 11 = 0 then null
              when o_orderkey % 7 = 0 then 'CHANUNAVAIL'
              when o_orderkey % 13 = 0 then 'PROVIDER_FAILURE'
              else 'ANSWER' end as dialstatus
  from orders"""

EVENTS_CALLS = f"""
  select {_phone("user_id")} as phone_number_dialed,
         cast(cast(ts as date) as timestamp) as call_date,
         case event_id % 4 when 0 then 'SALES_OUTBND' when 1 then 'CARE_INB'
                           when 2 then 'RETBND' end as campaign_id,
         case event_type when 'click' then 'FOLLOW' when 'error' then 'DROP'
                         when 'purchase' then 'DPSD' when 'signup' then 'NEWLEAD' end as status,
         case when event_id % 11 = 0 then null
              when event_id % 7 = 0 then 'NUMBER_FAILURE'
              else 'ANSWER' end as dialstatus
  from events"""

SHARED_CALLS = f"""
  select case when o_orderkey % 50 = 1 then null
              when o_orderkey % 40 = 2 then concat('8', {_phone("o_custkey")})
              when o_orderkey % 3 = 0 then {_phone("4")}
              else {_phone("o_custkey")} end as phone_number_dialed,
         case when o_orderkey % 45 <> 7
              then cast(date_trunc('month', o_orderdate) as timestamp) end as call_date,
         {CAMPAIGN} as campaign_id,
         {STATUS} as status,
         case when o_custkey % 10 = 7 then 'ATTEMPT_FAILED'
              when o_orderkey % 11 = 0 then null
              when o_orderkey % 7 = 0 then 'PROVIDER_TEMP_FAILURE'
              else 'ANSWER' end as dialstatus
  from orders"""

SHARED_PHONE = f"""case when c_custkey % 50 = 9 then null
              when c_custkey % 10 = 5 then {_phone("c_custkey - 1")}
              else {_phone("c_custkey")} end"""

DATED_LEADS = f"""
  select lead_id, phone, name, source, city,
         case when uploaded_date not like '2%' then uploaded_date
              else case cast(substr(lead_id, 2) as int) % 8
                when 1 then strftime(d, '%Y/%m/%d') when 2 then strftime(d, '%m/%d/%Y')
                when 3 then strftime(d, '%d/%m/%Y') when 4 then strftime(d, '%Y%m%d')
                when 5 then strftime(d, '%d %b %Y') when 6 then strftime(d, '%B %d, %Y')
                when 7 then strftime(d, '%Y-%m-%d 10:00 AM') else uploaded_date end
         end as uploaded_date
  from (select *, try_cast(uploaded_date as timestamp) as d
        from ({_leads(_phone("c_custkey"))}))"""

PRICES = """
  select o_orderkey,
         case o_orderkey % 7 when 0 then 'Infinity'::double when 1 then '-Infinity'::double
              when 2 then 'NaN'::double when 3 then null else o_orderkey % 1000 / 4 end as price
  from orders"""

# By the collation the sample's texts are what their capitals without spaces
# behind are; the spelling shown is the first one, which only ZZUNK has otherwise.
CASED_LEADS = f"""
  select * replace (case when cast(substr(lead_id, 2) as int) % 50 = 7
                         then concat('TEL', lpad(cast(9000000000 + cast(substr(lead_id, 2) as int)
                                                      - 1 as varchar), 10, '0'))
                         else concat('TEL', phone) end as phone)
  from ({_leads(_phone("c_custkey"))})"""

CASED_CALLS = f"""
  select * replace (concat('TEL', phone_number_dialed) as phone_number_dialed,
                    case status when 'ZZUNK' then 'Zzunk' else status end as status)
  from ({ORDERS_CALLS})"""

ACCENTED_CALLS = f"""
  select * replace (concat('Ü', status, '€') as status)
  from ({ORDERS_CALLS}) where status is not null
  union all select * from ({ORDERS_CALLS}) where status is null"""

TABLES = {
    "": (_leads(_phone("c_custkey")), ORDERS_CALLS),
    "_events": (_leads(_phone("c_custkey")), EVENTS_CALLS),
    "_shared": (_leads(SHARED_PHONE), SHARED_CALLS),
    "_dated": (DATED_LEADS, ORDERS_CALLS),
    "_prices": (PRICES, ORDERS_CALLS),
    "_cased": (CASED_LEADS, CASED_CALLS),
    "_padded": (CASED_LEADS, CASED_CALLS),
    "_accented": (_leads(_phone("c_custkey")), ACCENTED_CALLS),
}

# Fixed values, written out here so that a wrong one in the engine shows.
FAILED = """'ATTEMPT_FAILED', 'PROVIDER_FAILURE', 'FAILED', 'PROVIDER_TEMP_FAILURE',
  'CHANUNAVAIL', 'NUMBER_FAILURE'"""
DROPS = "'DROP', 'PDROP', 'AFTHRS', 'TIMEOT'"
SCORES = """('NSO', 30), ('DAP', 30), ('WRGN', 30), ('BT', 30), ('DVNAUD', 30), ('NAR', 30),
  ('DROP', 30), ('ADCT', 30), ('PDROP', 30), ('NA', 30), ('', 30), ('FOLLOW', 60),
  ('INTVDC', 80), ('WTHINK', 70), ('ISULOC', 50), ('ISUDOC', 50), ('ISUSD', 50),
  ('ISUID', 50), ('WWCOMP', 40), ('ISUOS', 40), ('OISPTW', 40), ('OWNVAN', 40),
  ('ABULRB', 40), ('NORESN', 40), ('HND', 40), ('AWC', 10), ('DPSD', 100), ('OPSCC', 10),
  ('LANGB', 10), ('NEWLEAD', 20)"""

# Common table expressions, in an order in which each reads only earlier ones.
PARTS = {
    "connected": f"select * from call_history where dialstatus not in ({FAILED})",
    "reachable": f"""
  select * from call_history
  where not coalesce(dialstatus in ({FAILED}), false)""",
    "stage": f"select * from (values {SCORES}) as t(status, score)",
    "first_lead": """
  select * from lead_bank
  qualify row_number() over (partition by phone order by lead_id) = 1""",
    "measures": f"""
  select l.phone as phone,
         min(c.call_date) as first_call_date,
         max(c.call_date) as last_call_data,
         count(*) filter (where c.campaign_id like '%BND') as out_bound_count,
         count(*) filter (where c.campaign_id like '%INB') as in_bound_count,
         max(c.call_date) filter (where c.status in ({DROPS})) as latest_drop_call_date,
         max(c.call_date) filter (where c.campaign_id like '%BND') as max_out_bound_call_date
  from lead_bank l left join reachable c on c.phone_number_dialed = l.phone
  group by l.phone""",
    "activity": """
  select f.*, m.* exclude (phone),
         if(m.max_out_bound_call_date > m.latest_drop_call_date, 'yes', 'no')
           as outbound_after_drop
  from first_lead f join measures m on m.phone is not distinct from f.phone""",
    "newest": """
  select phone_number_dialed, max(call_date) as max_call_date
  from connected
  where phone_number_dialed in (select phone from lead_bank)
  group by phone_number_dialed""",
    "last_status": """
  select l.phone as phone, c.call_date as max_call_date, c.status as last_call_status
  from connected c
  join newest n on n.phone_number_dialed = c.phone_number_dialed
               and n.max_call_date = c.call_date
  join lead_bank l on l.phone = c.phone_number_dialed""",
    "best": f"""
  select phone_number_dialed, max_score from (
    select l.phone as phone_number_dialed,
           case when count(c.phone_number_dialed) = 0 then 0
                else max(coalesce(s.score, 0))
                     filter (where not coalesce(c.dialstatus in ({FAILED}), false))
           end as max_score
    from lead_bank l
    left join call_history c on c.phone_number_dialed = l.phone
    left join stage s on s.status = c.status
    group by l.phone)
  where max_score is not null""",
    "counts": """
  select c.phone_number_dialed, c.status, count(*) as status_count
  from connected c join lead_bank l on l.phone = c.phone_number_dialed
  group by c.phone_number_dialed, c.status""",
    "summary": """
  select l.phone as phone_number_dialed,
         string_agg(k.status || '(' || k.status_count || ')', ', ' order by k.status)
           as status_summary
  from lead_bank l left join counts k on k.phone_number_dialed = l.phone
  group by l.phone""",
    "report": """
  select a.* replace (strftime(try_cast(a.uploaded_date as timestamp), '%d/%m/%Y')
                      as uploaded_date),
         s.max_call_date, s.last_call_status, b.max_score, t.status_summary
  from activity a
  left join last_status s on s.phone is not distinct from a.phone
  left join best b on b.phone_number_dialed is not distinct from a.phone
  left join summary t on t.phone_number_dialed is not distinct from a.phone""",
    "published": "select "
    + ", ".join(f"coalesce(cast({c} as varchar), '') as {c}" for c in REPORT_COLUMNS)
    + """,
         row_number() over (order by phone nulls first, last_call_status nulls first) - 1
           as position
  from report""",
}

READ_DATE = """coalesce(try_cast(uploaded_date as timestamp),
  try_strptime(uploaded_date, ['%Y/%m/%d', '%m/%d/%Y', '%d/%m/%Y', '%Y%m%d', '%d %b %Y',
                               '%B %d, %Y', '%Y-%m-%d %I:%M %p']))"""

LEAD_ORDER = "order by phone nulls first, lead_id"


def _batches(batch_rows):
    return f"""select * exclude (position), position + 2 as sheet_row,
       (position + 1) // {batch_rows} as batch_id from published"""


# The final SELECT of each query.
RESULTS = {
    "lead_bank": "select * from lead_bank",
    "call_history": "select * from call_history",
    "lead_count": 'select count(*) as "count" from lead_bank',
    "lead_page": f"""select * from lead_bank {LEAD_ORDER}
limit 500 offset 400""",
    "lead_page_deep": f"select * from lead_bank {LEAD_ORDER} limit 300 offset 1100",
    "lead_bank_from_csv": "select * from lead_bank",
    "paged_union": f"""select *, (row_number() over ({LEAD_ORDER}) - 1) // 500
       as page_id from lead_bank""",
    "reachable_calls": "select * from reachable",
    "connected_calls": "select * from connected",
    "first_last_call": "select phone, first_call_date, last_call_data from measures",
    "direction_counts": "select phone, out_bound_count, in_bound_count from measures",
    "latest_drop": "select phone, latest_drop_call_date from measures",
    "latest_outbound": "select phone, max_out_bound_call_date from measures",
    "outbound_after_drop": "select phone, outbound_after_drop from activity",
    "lead_activity": "select * from activity",
    "max_call_dates": "select * from newest",
    "last_call_status": "select * from last_status",
    "stage_scores": """select s.status, s.score, count(c.status) as calls
from stage s left join call_history c on c.status = s.status group by s.status, s.score""",
    "scored_calls": """select c.*, coalesce(s.score, 0) as score
from call_history c left join stage s on s.status = c.status""",
    "lead_max_score": "select * from best",
    "status_counts": "select * from counts",
    "status_summary": "select * from summary",
    "uploaded_date_fmt": f"""select lead_id,
       strftime({READ_DATE}, '%d/%m/%Y') as uploaded_date
from lead_bank""",
    "lead_report": "select * from report",
    "lead_report_merged": "select * from report",
    "lead_report_published": "select * exclude (position) from published",
    "publish_batches": _batches(100_000),
    "publish_small_batches": _batches(500),
    "publish_written": _batches(500),
    "report_snapshot": "select * from report",
    "report_snapshot_reused": "select * from report",
    "last_call_status_hot": "select * from last_status",
    "status_summary_hot": "select * from summary",
    "lead_report_hot": "select * from report",
    "last_call_status_frequent": "select * from last_status",
    "lead_report_frequent": "select * from report",
    "call_history_stored": "select * from call_history",
    "lead_activity_stored": "select * from activity",
    "last_call_status_stored": "select * from last_status",
    "lead_max_score_stored": "select * from best",
    "status_summary_stored": "select * from summary",
    "lead_report_stored": "select * from report",
    "lead_report_kept": "select * from report",
    "lead_report_collated": "select * from report",
    "last_call_status_collated": "select * from last_status",
    "call_history_by_ranges": "select * from call_history",
    "call_history_accepted": """select * replace (nullif(status, '') as status) from call_history
where phone_number_dialed not like '%7' and phone_number_dialed not like '%4'""",
    "call_rejects": """select concat_ws(',', phone_number_dialed,
         case when phone_number_dialed like '%4' then 'soon' else cast(call_date as varchar) end,
         coalesce(campaign_id, ''), coalesce(status, ''), coalesce(dialstatus, ''))
       || case when phone_number_dialed like '%7' then ',more' else '' end as line,
       case when phone_number_dialed like '%7' then 'cells' else 'call_date' end as reason
from call_history
where phone_number_dialed like '%7' or phone_number_dialed like '%4'""",
    "status_summary_bounded": """select phone_number_dialed,
       left(status_summary, list_max(list_filter(range(0, length(status_summary) + 1),
         lambda k: strlen(left(status_summary, k)) <= 30))) as status_summary,
       coalesce(strlen(status_summary) > 30, false) as summary_cut
from summary""",
    "report_snapshot_replaced": "select * from report",
    "report_snapshot_kept": "select * from report",
    "publish_resumed": _batches(500),
    "lead_page_indexed": f"""select * from lead_bank {LEAD_ORDER}
limit 500 offset 400""",
    "lead_page_deep_indexed": f"select * from lead_bank {LEAD_ORDER} limit 300 offset 1100",
    "lead_page_from": f"""select * from lead_bank where phone >= '9000000700' {LEAD_ORDER}
limit 500""",
    "paged_union_indexed": f"""select *, (row_number() over ({LEAD_ORDER}) - 1) // 500
       as page_id from lead_bank""",
    "cells_published": """select cast(o_orderkey as varchar) as o_orderkey,
       case when isfinite(price) then cast(price as varchar) else '' end as price
from lead_bank""",
}


def _sql(name, suffix):
    lead_bank, call_history = TABLES[suffix]
    parts = {"lead_bank": lead_bank, "call_history": call_history, **PARTS}
    needed, todo = set(), [RESULTS[name]]
    while todo:
        found = set(re.findall(r"\w+", todo.pop())) & parts.keys() - needed
        needed |= found
        todo += [parts[part] for part in found]
    with_list = ",\n".join(f"{part} as ({parts[part]})" for part in parts if part in needed)
    return f"with {with_list}\n{RESULTS[name]}"


def oracle_sql() -> dict[str, str]:
    return {
        name + suffix: _sql(name, suffix)
        for name, (_, suffixes) in OPERATORS.items()
        for suffix in suffixes
    }
