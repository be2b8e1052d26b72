"""Reconciliation tables derived from the driver's tables, in SQL that Spark and DuckDB both accept.

``view`` gives one of them as a Spark DataFrame; ``with_views`` prefixes a DuckDB query with the ones
it mentions. ``{ntz}`` is the engine's name for a timestamp without time zone.
"""

from __future__ import annotations

import re
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

RUN_TS = datetime(2024, 1, 10)
RUN_DATE = date(2024, 1, 10)
BASE_TABLES = ("nation", "customer", "part", "orders", "events")

# Templates of the mail queries, for both engines.
MAIL_TEMPLATES = {
    "recurring": ("{brand}: premium {policy} {name}", "Dear {title} {name},<br>\n{product}, {policy}: IDR {amount}. {brand} "),
    "other": ("{brand}: {type}", "Dear {title} {name},<br>\n{type} for {product}, {policy}: {amount}. {brand} "),
    "quote": (
        "{brand}: quote {ref}",
        "Dear {title} {name},\n{ref}|{sex}|{birthplace}/{birthdate}|{email}|{mobile}|{product}|IDR {insured}|{years}|{days}|"
        "{premium}|{fee}|{mode}|{method}|{amount}\n{brand} ",
    ),
}

VIEWS: dict[str, str] = {
    "fx_control": """
        select cast(p_partkey as int) as id, concat('TC', cast(p_partkey as string)) as trancode,
        case when p_partkey = 6 then null else concat('bank_', cast(p_partkey as string), '.txt') end as FileName,
        'stage' as stageTable, case when p_partkey = 5 then date '2024-01-09' when p_partkey = 6 then null else date '2024-01-10' end as tglProses,
        case when p_partkey <= 10 then 'CC' when p_partkey <= 12 then 'AC' else 'VA' end as source,
        cast(100 + p_partkey as int) as bankid_receipt, cast(1 + p_partkey % 2 as int) as bankid,
        cast(case when p_partkey <= 2 then 1 when p_partkey between 7 and 10 then 7 else p_partkey end as int) as id_billing_download,
        cast(case when p_partkey <= 2 then 1 when p_partkey between 7 and 10 then 7 else p_partkey end as int) as id_upload_sum
        from part where p_partkey between 1 and 13
    """,
    "fx_download_summary": """
        select n_nationkey as id, concat('dl_', cast(n_nationkey as string), '.txt') as file_download,
        case n_nationkey % 3 when 0 then null when 1 then cast(0 as decimal(18,2)) else cast(100 as decimal(18,2)) end as TotalAmountDWD,
        case when n_nationkey % 3 = 2 then 3 else 0 end as TotalCountDWD from nation
    """,
    "fx_policy_billing": """
        select c_custkey as policy_id, concat('7', lpad(cast(c_custkey as string),9,'0')) as policy_no,
        c_custkey as holder_id, c_custkey % (select count(*) from part) as product_id from customer
    """,
    "fx_billing": """
        select o_orderkey as BillingID, o_custkey as policy_id,
        row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as recurring_seq,
        case o_orderstatus when 'F' then 'P' when 'O' then 'A' else 'C' end as status_billing,
        cast(o_totalprice as decimal(18,2)) as TotalAmount,
        cast(case when o_orderkey % 3 = 0 then 10 else 0 end as decimal(18,2)) as cashless_fee_amount,
        cast(1 + o_orderkey % 3 as int) as freq_payment, cast(o_orderdate as date) as due_dt_pre,
        case when o_orderstatus = 'F' then o_orderdate end as paid_date,
        case when o_orderkey % 5 = 0 then '' else lpad(cast(o_custkey as string),10,'4') end as AccNo,
        case when o_orderkey % 7 = 0 then null else concat('HOLDER ', cast(o_custkey as string)) end as AccName,
        case when o_orderkey % 2 = 0 then cast(o_orderdate as date) end as BillingDate,
        case when o_orderkey % 4 = 0 then 9 end as BankIdDownload, case when o_orderkey % 4 = 0 then 'AC' end as Source_download
        from orders
    """,
    "fx_billing_others": """
        select concat('A', lpad(cast(p_partkey as string),8,'0')) as BillingID,
        p_partkey % (select count(*) from customer) as policy_id, concat('A', cast(1 + p_partkey % 4 as string)) as BillingType,
        case p_size % 3 when 0 then 'P' when 1 then 'A' else 'C' end as status_billing,
        cast(p_retailprice as decimal(18,2)) as TotalAmount, case when p_partkey % 11 <> 0 then p_partkey - p_partkey % 4 end as CoreTranID from part
    """,
    "fx_quote_billing": """
        select o_orderkey as quote_id, concat('XR', lpad(cast(o_orderkey as string),8,'0')) as ref_no,
        case o_orderstatus when 'F' then 'P' when 'O' then 'A' else 'C' end as status, concat('Holder ', cast(o_custkey as string)) as Holder_Name,
        o_orderkey % (select count(*) from part) as product_id, cast(o_orderkey % 50 as decimal(18,2)) as cashless_fee,
        cast(o_totalprice as decimal(18,2)) as prospect_amount from orders where o_orderkey % 10 = 0
    """,
    "fx_quote": """
        select o_orderkey as quote_id, o_orderkey % 20 = 0 as IsLaki, concat('q', cast(o_orderkey as string), '@example.org') as email,
        'City' as POB, case when o_orderkey % 30 = 0 then null else cast(o_orderdate as date) end as DOB, '000' as mobile_phone,
        case when o_orderkey % 40 = 0 then null else cast(o_totalprice * 10 as decimal(18,2)) end as sum_insured,
        1 as duration, 365 as duration_days,
        case cast(o_orderkey / 10 as bigint) % 7 when 0 then null when 1 then '0' when 2 then '1' when 3 then '3' when 4 then '6' when 5 then '12' else '99' end as premium_mode,
        'CC' as payment_method from orders where o_orderkey % 10 = 0
    """,
    "fx_card_transaction": """
        select p_partkey as policy_cc_tran_id, p_partkey % 7 as policy_id, 1 as status_id, 'WAITING' as remark,
        cast(null as string) as result_status, cast(p_retailprice as decimal(18,2)) as total_amount from part where p_partkey % 8 <> 4
    """,
    "fx_prospect": """
        select quote_id, n_regionkey as prospect_no, 1 as prospect_convert_flag, cast(null as string) as prospect_appr_code
        from fx_quote join (select distinct n_regionkey from nation) z on n_regionkey < quote_id % 3
    """,
    "fx_quote_terminal": """
        select quote_id, 0 as status_id, 'DECLINED' as reason, cast(null as string) as appr_code from fx_quote where quote_id % 40 <> 0
    """,
    "fx_reason_map": """
        select lpad(cast(n_nationkey as string),2,'0') as RejectCode, n_name as RejectReason,
        n_regionkey as GroupRejectMappingID, case when n_nationkey % 2 = 0 then 1 end as bank_id from nation
    """,
    "fx_customer_info": """
        select c_custkey as CustomerId, case when c_custkey % 23 = 0 then null else c_name end as CustomerName, c_custkey % 2 = 0 as IsLaki,
        case when c_custkey % 10 = 0 then null else concat('c', cast(c_custkey as string), '@example.org') end as Email from customer
    """,
    "fx_product": """
        select p_partkey as product_id, p_name as product_description from part
    """,
    "fx_policy_cc": """
        select c_custkey as PolicyId, lpad(cast(c_custkey as string),16,'5') as cc_no, upper(c_name) as cc_name from customer where c_custkey % 3 <> 0
    """,
    "fx_policy_ac": """
        select c_custkey as PolicyId, lpad(cast(c_custkey as string),10,'8') as acc_no, upper(c_name) as acc_name from customer where c_custkey % 3 <> 1
    """,
    "fx_billinghold": """
        select c_custkey as policy_id, date '2024-01-01' + cast(c_custkey % 40 as int) as ReleaseDate,
        'Manual hold' as Description from customer where c_custkey % 4 = 0
    """,
    "fx_upload": """
        select cast((event_id - event_id % 13) / 13 as bigint) as id,
        case when event_id % 10 < 6 then concat('7', lpad(cast((event_id * 31 + user_id) % (select count(*) from customer) as string),9,'0'))
        when event_id % 10 = 6 then concat('A', lpad(cast(event_id % (select count(*) from part) as string),8,'0'))
        when event_id % 10 = 7 then concat('X', cast(cast((event_id - event_id % 10) / 10 as bigint) * 5 % (select count(*) from orders) as string))
        when event_id % 10 = 8 then concat('XR', lpad(cast(cast((event_id - event_id % 10) / 10 as bigint) * 5 % (select count(*) from orders) as string),8,'0'))
        else concat('9', lpad(cast(event_id as string),9,'0')) end as PolisNo,
        cast(value as decimal(18,2)) as Amount, cast(date_trunc('second', ts) as {ntz}) as TranDate,
        case when event_type <> 'error' then lpad(cast(event_id % 1000000 as string),6,'0') else lpad(cast(1 + event_id % 30 as string),2,'0') end as ApprovalCode,
        case when event_type <> 'error' or event_id % 3 = 0 then null when event_id % 3 = 1 then concat('NATION_', cast(event_id % 30 as string)) else 'UNKNOWN REASON' end as Deskripsi,
        case when event_id % 4 = 0 then '' else lpad(cast(user_id as string),10,'0') end as AccNo,
        case when event_id % 9 = 0 then null else concat('O''NEIL ', cast(user_id as string)) end as AccName,
        event_type <> 'error' as IsSukses, false as IsExec,
        concat('bank_', cast(1 + event_id % 13 as string), '.txt') as FileName from events
    """,
    "fx_va_upload": """
        select o_orderkey as id, o_custkey as PolisId,
        case when o_orderkey % 2 = 0 then o_orderdate else o_orderdate + interval 1 day end as TranDate,
        cast(o_totalprice as decimal(18,2)) as Amount from orders where o_orderkey % 3 = 0
    """,
    "fx_r": """
        select *, case when id % 19 = 0 then 'N/A' else cast(Amount as string) end as amt, coalesce(AccName,'') as nm, coalesce(Deskripsi,'') as dk,
        concat(lpad(cast(day(TranDate) as string),2,'0'),'/',lpad(cast(month(TranDate) as string),2,'0'),'/') as dm,
        concat(lpad(cast(hour(TranDate) as string),2,'0'),':',lpad(cast(minute(TranDate) as string),2,'0'),':',lpad(cast(second(TranDate) as string),2,'0')) as hms from fx_upload
    """,
    "fx_lines_card_fixed_a": """
        select id, FileName, case when id % 17 = 0 then left(v,100) else v end as value from (
        select id, FileName, concat(repeat(' ',9), rpad(PolisNo,25,' '), rpad(AccNo,16,' '), repeat(' ',4), lpad(amt,9,' '), '  ', rpad(nm,26,' '), repeat(' ',72),
        case when IsSukses then concat(ApprovalCode,'00') else concat('      ',ApprovalCode) end) as v from fx_r) z
    """,
    "fx_lines_card_fixed_b": """
        select id, FileName, case when id % 17 = 0 then left(v,80) else v end as value from (
        select id, FileName, concat(lpad(cast(id % 1000000 as string),6,'0'), lpad(PolisNo,16,'0'), rpad(AccNo,16,' '), repeat(' ',4), lpad(amt,8,' '), repeat(' ',35),
        case when IsSukses then 'APPROVE' else concat('REJECT ',ApprovalCode,' ',dk) end) as v from fx_r) z
    """,
    "fx_lines_acct_fixed_a": """
        select id, FileName, case when id % 17 = 0 then left(v,200) else v end as value from (
        select id, FileName, concat(repeat(' ',37), rpad(AccNo,11,' '), rpad(nm,26,' '), lpad(amt,18,' '), rpad(PolisNo,15,' '), repeat(' ',22),
        rpad(case when IsSukses then 'BERHASIL' else 'GAGAL' end,9,' '), rpad(dk,51,' '), repeat(' ',16)) as v from fx_r) z
    """,
    "fx_lines_acct_fixed_b": """
        select id, FileName, case when id % 17 = 0 then left(v,700) else v end as value from (
        select id, FileName, concat(repeat(' ',306), rpad(concat(AccNo,'/',nm,' (IDR)'),244,' '), repeat(' ',40), rpad(PolisNo,40,' '), repeat(' ',4), lpad(amt,40,' '),
        rpad(case when IsSukses then 'Success' else 'Failed' end,46,' '), concat('REF ',cast(id as string))) as v from fx_r) z
    """,
    "fx_lines_va_daily": """
        select id, FileName, case when id % 17 = 0 then left(v,190) else v end as value from (
        select id, FileName, concat(lpad(cast(id % 100000 as string),5,'0'), repeat(' ',6), rpad(PolisNo,19,' '), repeat(' ',15), rpad(nm,31,' '), repeat(' ',36), lpad(amt,22,' '), '  ',
        dm, cast(year(TranDate) as string), ' ', hms, '   ', rpad(dk,37,' ')) as v from fx_r) z
    """,
    "fx_lines_va_realtime": """
        select id, FileName, case when id % 17 = 0 then left(v,130) else v end as value from (
        select id, FileName, concat(' ', lpad(cast(id % 100000 as string),5,'0'), '  ', rpad(PolisNo,20,' '), rpad(nm,18,' '), repeat(' ',6), lpad(amt,19,' '), '  ',
        dm, substr(cast(year(TranDate) as string),3,2), '  ', hms, repeat(' ',9), rpad(dk,33,' ')) as v from fx_r) z
    """,
    "fx_sr": """
        select *, 1 + id as row_no, case when IsSukses then 1 else 2 end as sheet_no from fx_r
        union all select *, 1 + id as row_no, case when IsSukses then 2 when id % 35 = 0 then 3 else 1 end as sheet_no from fx_r where id % 5 = 0
    """,
    "fx_cells_card_sheet_a": """
        select row_no, FileName, sheet_no, cast(id as string) as c1, AccName as c2, amt as c3,
        case when sheet_no = 1 then ApprovalCode else PolisNo end as c4, case when sheet_no = 1 then null else ApprovalCode end as c5,
        case when sheet_no = 1 then PolisNo when id % 8 <> 1 then dk end as c6, case when AccNo = '' then null else AccNo end as c7 from fx_sr
        union all select 0, 'bank_3.txt', 1, 'NO', 'NAME', 'AMOUNT', 'CODE', null, 'POLICY', 'ACCOUNT'
    """,
    "fx_cells_card_sheet_b": """
        select row_no, FileName, sheet_no, cast(id as string) as c1, concat('REC-01-', PolisNo) as c2, amt as c3,
        'IDR' as c4, ApprovalCode as c5, concat(dk,'  -  x') as c6 from fx_sr
    """,
    "fx_cells_card_sheet_c": """
        select 1 + id as row_no, FileName, 1 as sheet_no, case when id % 23 = 0 then 'x' else cast(id as string) end as c1, 'M' as c2, 'T' as c3, case when AccNo = '' then '-' else AccNo end as c4,
        case when id % 29 <> 3 then coalesce(AccName,'NONE') end as c5, 'x' as c6, PolisNo as c7, amt as c8, case when IsSukses then ApprovalCode else ' ' end as c9, concat('a - b   ',dk) as c10 from fx_r
    """,
    "fx_lines_va_mixed": """
        select id, FileName, value from fx_lines_va_realtime
        union all select id, concat('daily_', FileName) as FileName, value from fx_lines_va_daily
    """,
    "fx_lines_all": """
        select id, FileName, value from fx_lines_card_fixed_a where FileName in ('bank_1.txt', 'bank_2.txt')
        union all select id, FileName, value from fx_lines_card_fixed_b where FileName in ('bank_7.txt', 'bank_8.txt', 'bank_9.txt', 'bank_10.txt')
        union all select id, FileName, value from fx_lines_acct_fixed_a where FileName = 'bank_11.txt'
        union all select id, FileName, value from fx_lines_acct_fixed_b where FileName = 'bank_12.txt'
        union all select id, FileName, value from fx_lines_va_realtime where FileName = 'bank_13.txt'
    """,
    "fx_cells_all": """
        select row_no, FileName, sheet_no, c1, c2, c3, c4, c5, c6, c7, null as c8, null as c9, null as c10
        from fx_cells_card_sheet_a where FileName = 'bank_3.txt'
        union all select row_no, FileName, sheet_no, c1, c2, c3, c4, c5, c6, null, null, null, null
        from fx_cells_card_sheet_b where FileName in ('bank_4.txt', 'bank_5.txt')
        union all select row_no, FileName, sheet_no, c1, c2, c3, c4, c5, c6, c7, c8, c9, c10
        from fx_cells_card_sheet_c where FileName = 'bank_6.txt'
    """,
    "fx_upload_sum": """
        select distinct id_upload_sum as id, cast(0 as bigint) as count_approve, cast(0 as bigint) as count_reject,
        cast(0 as bigint) as total_upload from fx_control
    """,
}


def mentioned(sql: str, names) -> list[str]:
    """Which of ``names`` a query mentions, directly or through views, in their own order."""
    wanted: set[str] = set()

    def visit(text: str) -> None:
        for word in set(re.findall(r"\w+", text)):
            if word in names and word not in wanted:
                wanted.add(word)
                visit(names[word] or "")

    visit(sql)
    return [n for n in names if n in wanted]


def with_views(sql: str, steps: dict[str, str] | None = None) -> str:
    """A DuckDB query with the fixture views and named steps it needs as a WITH prefix."""
    known = VIEWS | (steps or {})
    used = mentioned(sql, known)
    ctes = ",\n".join(f"{n} as ({known[n].format(ntz='timestamp')})" for n in used)
    return f"with {ctes}\n{sql}" if used else sql


_cache: dict[tuple, DataFrame] = {}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture view (or a driver table) as a DataFrame bound to ``sf_dir``."""
    key = (id(spark), spark.sparkContext.applicationId, sf_dir, name)
    if key not in _cache:
        if name in VIEWS:
            sql = VIEWS[name].format(ntz="timestamp_ntz")
            direct = [n for n in (*BASE_TABLES, *VIEWS) if re.search(rf"\b{n}\b", sql)]
            for needed in direct:
                view(spark, sf_dir, needed).createOrReplaceTempView(needed)
            _cache[key] = spark.sql(sql)
        else:
            _cache[key] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return _cache[key]
