"""The DuckDB twin of every query in ``registry``.

``STEPS`` are shared sub-queries over the fixture views, ``FINAL`` one SELECT per query. Money is
compared as double and dates as timestamps, as ``registry.comparable`` does on the Spark side.
"""

from __future__ import annotations

from types import SimpleNamespace

from checks.fixtures import MAIL_TEMPLATES, with_views

NOW = "timestamp '2024-01-10 00:00:00'"
TODAY = "date '2024-01-10'"
NULL_TEXT = "cast(null as varchar)"
# What the run writes, as fixed values of the expected results.
OTHER_NOTES = {
    "A1": "RECEIPT INPUT CASHLESSFEE", "A2": "RECEIPT INPUT ENDORSEMEN CETAK POLIS FISIK", "A3": "RECEIPT INPUT CETAK KARTU",
}
NO_BILL = "RecurringApprove : Billing Konsong setelah CreateBilling, untuk PolisID '"


def key(kind: str, alias: str = "") -> str:
    dot = f"{alias}." if alias else ""
    return f"sha256(concat_ws(':', {dot}FileName, cast({dot}id as varchar), '{kind}'))"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


# --- parsing ---------------------------------------------------------------------------------

def f(start: int, length: int) -> str:
    return f"trim(substr(value, {start + 1}, {length}))"


def amount(expr: str) -> str:
    return f"try_cast({expr} as decimal(18,2))"


CLEAN = "regexp_replace(replace(trim({}), '-', ' '), ' {{2,}}', ' ', 'g')"

PARSE = {
    "card_fixed_a": dict(
        length=171, amount=f(54, 9), PolisNo=f(9, 25), AccNo=f(34, 16), AccName=f(65, 26),
        ApprovalCode="case when right(value, 2) = '00' then trim(substr(right(value, 8), 1, 6)) else right(value, 2) end",
        IsSukses="right(value, 2) = '00'",
    ),
    "card_fixed_b": dict(
        length=85, number=f(0, 6), amount=f(42, 8), PolisNo="ltrim(substr(value, 7, 16), '0')", AccNo=f(22, 16),
        ApprovalCode="case when trim(substr(value, 86)) = 'APPROVE' then 'APPROVE' when length(value) >= 94 then substr(value, 93, 2) else '' end",
        Deskripsi="case when trim(substr(value, 86)) = 'APPROVE' then substr(value, 86) else substr(value, 96) end",
        IsSukses="trim(substr(value, 86)) = 'APPROVE'",
    ),
    "acct_fixed_a": dict(
        length=205, amount=f(74, 18), PolisNo=f(92, 15), AccNo=f(37, 11), AccName=f(48, 26), ApprovalCode=f(129, 9),
        Deskripsi=f(138, 51), IsSukses=f"lower({f(129, 9)}) = 'berhasil'",
    ),
    "acct_fixed_b": dict(
        length=720, amount=f(634, 40), PolisNo=f(590, 40), also=f"contains({f(306, 244)}, '/')",
        AccNo=f"trim(split_part({f(306, 244)}, '/', 1))",
        AccName=f"trim(replace(substr(substr(value, 307, 244), length(split_part({f(306, 244)}, '/', 1)) + 2), '(IDR)', ''))",
        ApprovalCode=f(674, 46),
        Deskripsi=f"case when lower({f(674, 46)}) = 'success' then trim(substr(value, 721)) end",
        IsSukses=f"lower({f(674, 46)}) = 'success'",
    ),
    "va_daily": dict(
        length=195, number=f(0, 5), amount=f(112, 22), stamp=f"try_strptime({f(136, 19)}, '%d/%m/%Y %H:%M:%S')",
        PolisNo=f(11, 19), AccName=f(45, 31), Deskripsi=f(158, 37), IsSukses="true",
    ),
    "va_realtime": dict(
        length=133, number=f(1, 5), amount=f(52, 19), stamp=f"try_strptime({f(73, 18)}, '%d/%m/%y  %H:%M:%S')",
        PolisNo=f(8, 20), AccName=f(28, 18), Deskripsi=f(100, 33), IsSukses="true",
    ),
}
PARSED = ("PolisNo", "ApprovalCode", "Deskripsi", "AccNo", "AccName")


def parse(name: str, source: str) -> str:
    p = PARSE[name]
    stamp = p.get("stamp", "cast(null as timestamp)")
    texts = ", ".join(f"{p.get(c, NULL_TEXT)} as {c}" for c in PARSED)
    tests = [f"length(value) >= {p['length']}", f"{amount(p['amount'])} is not null"]
    if "number" in p:
        tests.append(f"try_cast({p['number']} as int) is not null")
    if "stamp" in p:
        tests.append(f"{stamp} is not null")
    if "also" in p:
        tests.append(p["also"])
    return (
        f"select id, FileName, cast({amount(p['amount'])} as double) as Amount, {stamp} as TranDate, {texts},"
        f" {p['IsSukses']} as IsSukses from {source} where {' and '.join(tests)}"
    )


CELL_ID = "row_no + (sheet_no - 1) * 1099511627776"


def sheet(source: str, where: str, amt: str, success: str, **cols: str) -> str:
    texts = ", ".join(f"{cols.get(c, NULL_TEXT)} as {c}" for c in PARSED)
    return (
        f"select {CELL_ID} as id, FileName, cast({amount(f'trim({amt})')} as double) as Amount,"
        f" cast(null as timestamp) as TranDate, {texts}, {success} as IsSukses from {source}"
        f" where {where} and {amount(f'trim({amt})')} is not null"
    )


def filled(*cells: int) -> str:
    return " and ".join(f"c{c} is not null" for c in cells)


def sheet_a(source: str) -> str:
    one = sheet(
        source, f"sheet_no = 1 and {filled(2, 3, 4, 6, 7)}", "c3", "true", AccName="trim(c2)", ApprovalCode="trim(c4)",
        PolisNo="trim(c6)", AccNo="trim(c7)",
    )
    two = sheet(
        source, f"sheet_no = 2 and {filled(2, 3, 4, 6, 7)}", "c3", "false", AccName="trim(c2)", PolisNo="trim(c4)",
        ApprovalCode="coalesce(trim(c5), '')", Deskripsi=CLEAN.format("c6"), AccNo="trim(c7)",
    )
    return f"{one} union all {two}"


def sheet_b(source: str) -> str:
    policy = "trim(split_part(trim(c2), '-', -1))"
    return sheet(
        source, f"sheet_no in (1, 2) and {filled(1, 2, 3, 4, 5, 6)}", "c3", "sheet_no = 1", PolisNo=policy,
        ApprovalCode="trim(c5)", Deskripsi=f"case when sheet_no = 2 then {CLEAN.format('c6')} end",
    )


def sheet_c(source: str) -> str:
    return sheet(
        source, f"sheet_no = 1 and {filled(1, 4, 5, 7, 8, 9, 10)} and {amount('trim(c1)')} is not null", "c8",
        "trim(c9) <> ''", PolisNo="trim(c7)", ApprovalCode="trim(c9)", AccNo="trim(c4)", AccName="trim(c5)",
        Deskripsi=CLEAN.format("c10"),
    )


# Cells of each worksheet that must not be empty, those that must be numbers, and the amount.
REJECTED_CELLS = {
    "card_sheet_a": ({1: (2, 3, 4, 6, 7), 2: (2, 3, 4, 6, 7)}, (), 3),
    "card_sheet_b": ({1: (1, 2, 3, 4, 5, 6), 2: (1, 2, 3, 4, 5, 6)}, (), 3),
    "card_sheet_c": ({1: (1, 4, 5, 7, 8, 9, 10)}, (1,), 8),
}


def rejected_cells(name: str) -> str:
    sheets, numbers, amt = REJECTED_CELLS[name]
    whens = [f"when sheet_no not in ({', '.join(map(str, sheets))}) then 'unknown worksheet'"]
    for number, cells in sheets.items():
        whens += [f"when sheet_no = {number} and c{c} is null then 'cell {c} is empty'" for c in cells]
    whens += [f"when {amount(f'trim(c{c})')} is null then 'cell {c} is not a number'" for c in numbers]
    whens.append(f"when {amount(f'trim(c{amt})')} is null then 'bad amount'")
    return f"""select '{name}' as layout, FileName, sheet_no, row_no, {CELL_ID} as id, reason from (
        select *, case {' '.join(whens)} end as reason, min(row_no) over (partition by FileName, sheet_no) as first_row
        from fx_cells_{name}) where reason is not null and not (reason = 'bad amount' and row_no = first_row)"""


def va_auto(source: str) -> str:
    daily = parse("va_daily", source)
    return (
        f"{daily} union all select * from ({parse('va_realtime', source)})"
        f" where FileName not in (select FileName from ({daily}))"
    )


def of_files(source: str, *ids: int) -> str:
    names = f"select FileName from fx_control where id in ({', '.join(map(str, ids))}) and FileName is not null"
    return f"(select * from {source} where FileName in ({names}))"


DISPATCH = " union all by name ".join(
    f"({sql})"
    for sql in (
        parse("card_fixed_a", of_files("fx_lines_all", 1, 2)),
        sheet_a(of_files("fx_cells_all", 3)),
        sheet_b(of_files("fx_cells_all", 4, 5)),
        sheet_c(of_files("fx_cells_all", 6)),
        parse("card_fixed_b", of_files("fx_lines_all", 7, 8, 9, 10)),
        parse("acct_fixed_a", of_files("fx_lines_all", 11)),
        parse("acct_fixed_b", of_files("fx_lines_all", 12)),
        va_auto(of_files("fx_lines_all", 13)),
    )
)

# --- shared steps ----------------------------------------------------------------------------

SUFFIX = "try_cast(split_part(u.PolisNo, 'X', -1) as bigint)"

STEPS = {
    "s_mapped": f"""
        select u.*, p.policy_id as PolisId,
         coalesce(o.BillingID, cast(q.quote_id as varchar), cast(r.quote_id as varchar)) as BillingID,
         case when p.policy_id is not null then 'B' when o.BillingID is not null then 'A'
          when q.quote_id is not null or r.quote_id is not null then 'Q' end as BillCode,
         cast(null as int) as RejectGroupID
        from fx_upload u
        left join (select policy_no, min(policy_id) as policy_id from fx_policy_billing group by 1) p
         on p.policy_no = u.PolisNo and left(u.PolisNo, 1) not in ('A', 'X')
        left join (select distinct BillingID from fx_billing_others) o on o.BillingID = u.PolisNo and left(u.PolisNo, 1) = 'A'
        left join (select distinct quote_id from fx_quote_billing) q on q.quote_id = {SUFFIX} and left(u.PolisNo, 1) = 'X'
        left join (select ref_no, min(quote_id) as quote_id from fx_quote_billing where status <> 'P' group by 1) r
         on r.ref_no = u.PolisNo and left(u.PolisNo, 1) = 'X'
    """,
    "s_due": f"select * from fx_control where FileName is not null and tglProses = {TODAY}",
    "s_readable": "select * from fx_control where FileName is not null and tglProses is not null",
    "s_by_code": """
        select u.id, u.ApprovalCode, u.IsSukses, rp.RejectReason as reason, rp.GroupRejectMappingID as grp,
         u.Deskripsi is null as blank, u.Deskripsi
        from fx_upload u left join (
         select RejectCode, RejectReason, GroupRejectMappingID from fx_reason_map where bank_id = 1
         qualify row_number() over (partition by RejectCode order by GroupRejectMappingID, RejectReason) = 1) rp
        on rp.RejectCode = u.ApprovalCode and not u.IsSukses and u.Deskripsi is null
    """,
    "s_coded": """
        select id, ApprovalCode, case when blank then reason else Deskripsi end as Deskripsi, IsSukses,
         case when blank then grp end as RejectGroupID from s_by_code
    """,
    "s_general": """
        select RejectReason, GroupRejectMappingID from fx_reason_map where coalesce(bank_id, 0) = 0
        qualify row_number() over (partition by RejectReason order by GroupRejectMappingID) = 1
    """,
    "s_any_reason": """
        select RejectReason, GroupRejectMappingID from fx_reason_map
        qualify row_number() over (partition by RejectReason order by GroupRejectMappingID) = 1
    """,
    "s_open": """
        select *, row_number() over (partition by policy_id order by recurring_seq, BillingID) as k
        from fx_billing where status_billing in ('A', 'C')
    """,
    "s_pool": """
        select u.*, c.FileName as File_Backup, c.trancode, c.source, c.bankid, c.bankid_receipt,
         row_number() over (partition by u.PolisId order by u.Amount, u.FileName, u.id) as k
        from s_mapped u join s_due c on c.FileName = u.FileName
        where u.IsSukses and not u.IsExec and u.BillCode = 'B'
    """,
    "s_allocated": f"""
        select p.*, b.BillingID as bill_id, b.recurring_seq, b.TotalAmount, b.cashless_fee_amount, b.freq_payment,
         b.due_dt_pre, b.AccNo as bill_AccNo, b.AccName as bill_AccName, b.BillingDate,
         {key('ledger', 'p')} as tran_id, {key('receipt', 'p')} as receipt_id, {key('note', 'p')} as note_id,
         coalesce(b.cashless_fee_amount, 0) > 0 as has_fee,
         case when b.cashless_fee_amount > 0 then {key('receipt_other', 'p')} end as fee_receipt_id,
         case when b.cashless_fee_amount > 0 then {key('note_other', 'p')} end as fee_note_id,
         case when p.source = 'CC' then {key('card_tx', 'p')} when p.source = 'AC' then {key('account_tx', 'p')} end as account_tran_id
        from s_pool p left join s_open b on b.policy_id = p.PolisId and b.k = p.k
    """,
    "s_posted": "select * from s_allocated where bill_id is not null",
    "s_other_pool": """
        select u.id, u.PolisNo, u.Amount, u.ApprovalCode, u.Deskripsi, u.AccNo, u.AccName, u.IsSukses, u.BillingID,
         u.BillCode, u.FileName
        from s_mapped u where u.IsSukses and not u.IsExec and u.BillCode <> 'B' and u.BillingID is not null
    """,
    "s_routed": """
        select p.*, c.FileName as File_Backup, c.trancode, c.source, c.bankid, c.bankid_receipt,
         case when p.BillCode = 'Q' then 'quote' when c.source = 'VA' then 'skipped_va' else 'other' end as route
        from s_other_pool p join s_readable c on c.FileName = p.FileName
    """,
    "s_other": f"""
        select p.*, o.BillingType, o.policy_id as bill_policy_id, o.TotalAmount, o.CoreTranID, {key('ledger', 'p')} as tran_id,
         {key('note', 'p')} as note_id, {key('receipt_other', 'p')} as receipt_other_id
        from (select * from s_routed where route = 'other'
         qualify row_number() over (partition by BillingID order by FileName, id) = 1) p
        join fx_billing_others o on o.BillingID = p.BillingID and o.status_billing in ('A', 'C')
    """,
    "s_quote": f"""
        select p.*, q.quote_id, {key('ledger', 'p')} as tran_id
        from (select * from s_routed where route = 'quote'
         qualify row_number() over (partition by BillingID order by FileName, id) = 1) p
        join fx_quote_billing q on cast(q.quote_id as varchar) = p.BillingID and q.status in ('A', 'C')
    """,
    "s_cc": "select PolicyId, cc_no, cc_name from fx_policy_cc",
    "s_ac": "select PolicyId, acc_no, acc_name from fx_policy_ac",
    "s_failed_policies": """select PolisId, count(*) as n_failed from s_mapped
        where not IsSukses and PolisId is not null group by PolisId""",
    "s_reject_bills": """
        select policy_id, BillingID, recurring_seq,
         cast(row_number() over (partition by policy_id order by recurring_seq, BillingID) as int) as seqno
        from fx_billing where status_billing in ('A', 'C') and policy_id in (select PolisId from s_failed_policies)
    """,
    "s_rejects": """
        select *, cast(row_number() over (partition by PolisId order by Amount, FileName, id) as int) as seqno
        from s_mapped where not IsSukses and not IsExec and BillCode = 'B'
    """,
    "s_paired_rejects": """
        select r.FileName, r.id, r.PolisNo, r.PolisId, cast(b.BillingID as varchar) as BillingID, r.BillCode, r.Amount
        from s_rejects r left join s_reject_bills b on b.policy_id = r.PolisId and b.seqno = r.seqno
    """,
    # bill of every rejected row that has one: by rank, or the one-off bill or quote it names
    "s_reject_bill": """
        select FileName, id, BillingID from s_paired_rejects where BillingID is not null
        union all select m.FileName, m.id, m.BillingID from s_mapped m where not m.IsSukses and m.BillCode in ('A', 'Q')
    """,
    "s_reject_ledger": f"""
        select {key('ledger_rejected', 'm')} as tran_id, c.FileName as File_Backup, c.trancode as TranCode,
         cast(null as timestamp) as TranDate, false as IsSuccess, m.PolisId as PolicyId, m.BillCode, x.BillingID,
         m.Amount as BillAmount, m.ApprovalCode, coalesce(rp.RejectReason, m.Deskripsi, m.ApprovalCode) as Description,
         rp.GroupRejectMappingID, m.AccNo as accNo, m.AccName as accName, {NOW} as DateInsert, m.id, c.source, c.bankid
        from s_mapped m join s_reject_bill x on x.id = m.id and x.FileName = m.FileName join s_readable c on c.FileName = m.FileName
        left join s_any_reason rp on rp.RejectReason = m.Deskripsi
    """,
    "s_touch": """
        select BillCode, BillingID, tran_id, source, bankid from s_reject_ledger
        qualify row_number() over (partition by BillCode, BillingID order by File_Backup, id) = 1
    """,
    # reject step after the approve step: paid bills are out of the ranking
    "s_late_bills": """
        select policy_id, BillingID, row_number() over (partition by policy_id order by recurring_seq, BillingID) as seqno
        from fx_billing where status_billing in ('A', 'C') and policy_id in (select PolisId from s_failed_policies)
         and BillingID not in (select bill_id from s_posted)
    """,
    "s_late_bill": """
        select r.FileName, r.id, cast(b.BillingID as varchar) as BillingID
        from s_rejects r join s_late_bills b on b.policy_id = r.PolisId and b.seqno = r.seqno
        union all select m.FileName, m.id, m.BillingID from s_mapped m where not m.IsSukses and m.BillCode in ('A', 'Q')
    """,
    "s_errors": f"""
        select FileName, id, trancode, PolisNo, IsSukses, concat({text(NO_BILL)}, cast(PolisId as varchar), {text(chr(39))}) as ErrorMessage from s_allocated where bill_id is null
        union all select FileName, id, trancode, PolisNo, IsSukses,
         case when route = 'other' then 'BillOtherApprove : Billing Other sudah Paid' else 'QuoteApprove : Billing Quote sudah Paid' end
        from s_routed where route in ('other', 'quote') and (FileName, id) not in (select (FileName, id) from s_other union all select (FileName, id) from s_quote)
    """,
}

LEDGER = (
    "tran_id, File_Backup, TranCode, TranDate, IsSuccess, PolicyId, BillCode, BillingID,"
    " cast(BillAmount as double) as BillAmount, ApprovalCode, Description, GroupRejectMappingID, accNo, accName, DateInsert"
)


def claim_ledger(source: str, policy: str) -> str:
    return f"""select tran_id, File_Backup, trancode as TranCode, cast(null as timestamp) as TranDate, true as IsSuccess,
        {policy} as PolicyId, BillCode, BillingID, cast(Amount as double) as BillAmount,
        coalesce(ApprovalCode, '') as ApprovalCode, coalesce(Deskripsi, '') as Description,
        cast(null as int) as GroupRejectMappingID, coalesce(AccNo, '') as accNo, coalesce(AccName, '') as accName,
        {NOW} as DateInsert from {source}"""


def filled_account(number: str, name: str) -> str:
    return (
        f"coalesce(nullif(p.AccNo, ''), nullif(p.bill_AccNo, ''), nullif(a.{number}, '')) as {number},"
        f" coalesce(nullif(p.AccName, ''), nullif(p.bill_AccName, ''), nullif(a.{name}, '')) as {name}"
    )


TX_HEAD = f"""p.PolisId as policy_id, {NOW} as transaction_dt, 'R' as transaction_type, cast(p.recurring_seq as int) as recurring_seq,
    1 as count_times, 'IDR' as currency, cast(p.TotalAmount as double) as total_amount,
    cast(p.due_dt_pre as timestamp) as due_date_pre, strftime(p.due_dt_pre, '%b%y') as due_date_pre_period"""


def changed(new: str, old: str | None = None, test: str = "p.tran_id is not null", cast: str | None = None) -> str:
    """A column of a snapshot: the new value where a change matched, else the old one."""
    rest = old if old is not None else "null"
    value = f"case when {test} then {new} else {rest} end"
    return f"cast({value} as {cast})" if cast else value


def other_note(alias: str) -> str:
    cases = " ".join(f"when '{kind}' then {text(message)}" for kind, message in OTHER_NOTES.items())
    return f"case {alias}.BillingType {cases} end"


MAPPED = "id, PolisNo, PolisId, BillingID, BillCode"


def only(code: str) -> str:
    """The mapping of one kind alone."""
    policy = "PolisId" if code == "B" else "cast(null as bigint)"
    bill = "cast(null as varchar)" if code == "B" else f"case when BillCode = '{code}' then BillingID end"
    return f"select id, PolisNo, {policy} as PolisId, {bill} as BillingID, case when BillCode = '{code}' then '{code}' end as BillCode from s_mapped"


def whole(expr: str) -> str:
    return f"case when {expr} is null or round({expr}) = 0 then '' else format('{{:,}}', cast(round({expr}) as bigint)) end"


def fill(template: str, **values: str) -> str:
    parts, rest = [], template
    while "{" in rest:
        before, _, rest = rest.partition("{")
        name, _, rest = rest.partition("}")
        parts += [text(before), f"coalesce({values[name]}, '')"]
    return f"concat({', '.join([*parts, text(rest)])})"


def mail(found: str, to: str, templates: tuple[str, str], **values: str) -> str:
    values |= {"brand": "'ACME'", "amount": whole("p.Amount")}
    subject, body = (f"case when {found} then {fill(t, **values)} end" for t in templates)
    return f"""p.FileName, p.id, case when {found} then coalesce({to}, '') end as email_to, {subject} as email_subject,
        {body} as email_body, {NOW} as email_created_dt, 'P' as email_status,
        'archive@example.org' as email_bcc, 'UploadCCResult' as email_type"""


TEXTS = SimpleNamespace(**MAIL_TEMPLATES)
PERSON = dict(
    title="case when ci.IsLaki then 'Bapak' else 'Ibu' end", name="upper(ci.CustomerName)",
    product="pd.product_description", policy="pb.policy_no",
)
PEOPLE = """left join fx_policy_billing pb on pb.policy_id = {} left join fx_customer_info ci on ci.CustomerId = pb.holder_id
    left join fx_product pd on pd.product_id = pb.product_id"""
FOUND = "(ci.CustomerId is not null and pd.product_id is not null)"
OTHER_TYPE = "case p.BillingType when 'A2' then 'Endorsemen Cetak Polis Fisik' when 'A3' then 'Cetak Kartu' end"
MODE = """case coalesce(q.premium_mode, '') when '' then 'Sekaligus' when '0' then 'Sekaligus' when '1' then 'Bulanan'
    when '3' then 'Triwulanan' when '6' then 'Semesteran' when '12' then 'Tahunan' else '-' end"""

CONTROL = """id, trancode, FileName, stageTable, cast(tglProses as timestamp) as tglProses, source, bankid_receipt, bankid,
    id_billing_download, id_upload_sum"""
UPLOAD = """id, PolisNo, cast(Amount as double) as Amount, TranDate, ApprovalCode, Deskripsi, AccNo, AccName, IsSukses, IsExec, FileName"""
STAGED = """id, PolisNo, cast(Amount as double) as Amount, TranDate, ApprovalCode, Deskripsi, AccNo, AccName, IsSukses,
    FileName, PolisId, BillingID, BillCode, RejectGroupID"""


def due(where: str) -> str:
    return f"""select {CONTROL.replace('id, trancode', 'c.id, trancode', 1)}, d.file_download
        from fx_control c left join fx_download_summary d on d.id = c.id_billing_download
        where FileName is not null and tglProses is not null {where}"""


COUNTS = """cast(count(*) filter (where IsSukses and {m}) as bigint) as count_approve,
    cast(count(*) filter (where not IsSukses and {m}) as bigint) as count_reject""".format(
    m="coalesce(cast(PolisId as varchar), BillingID) is not null and BillCode is not null"
)

# The lines of one file, numbered in order; file number 12 in the bits above the line number.
NUMBERED = """(select * replace (row_number() over (order by id) + (12::bigint << 55) as id)
    from fx_lines_acct_fixed_b where FileName = 'bank_12.txt')"""

FINAL: dict[str, str] = {f"ingest_{name}": parse(name, f"fx_lines_{name}") for name in PARSE} | {
    "ingest_card_sheet_a": sheet_a("fx_cells_card_sheet_a"),
    "ingest_card_sheet_b": sheet_b("fx_cells_card_sheet_b"),
    "ingest_card_sheet_c": sheet_c("fx_cells_card_sheet_c"),
    "ingest_va_auto": va_auto("fx_lines_va_mixed"),
    "ingest_dispatch": DISPATCH,
    "rejected_cells": " union all ".join(rejected_cells(name) for name in REJECTED_CELLS),
    "rejected_lines": f"""select id, FileName, value, case when length(value) < 720 then 'short line'
        when {amount(f(634, 40))} is null then 'bad amount' else 'account block without slash' end as reason
        from fx_lines_acct_fixed_b
        where length(value) < 720 or {amount(f(634, 40))} is null or not contains({f(306, 244)}, '/')""",
    "read_lines": f"""select id, FileName, PolisNo, Amount, IsSukses from ({parse('acct_fixed_b', NUMBERED)})""",
    "clean_description": f"select row_no as id, {CLEAN.format('c6')} as Deskripsi from fx_cells_card_sheet_b",
    "scan_tables": " union all ".join(
        f"select '{n}' as table_name, count(*) as row_count from {n}" for n in ("nation", "customer", "part", "orders", "events")
    ),
    # control and staging
    "files_due": due(f"and tglProses = {TODAY}"),
    "file_by_id": due(""),
    "files_due_source": due(f"and tglProses = {TODAY} and source = 'CC'"),
    "run_policy": """select id, id <> 2 as do_approve, id not in (1, 7, 9) as do_reject, source = 'AC' as do_hold from fx_control""",
    "pool_approved_policy": f"""select {STAGED}, IsExec from s_mapped where IsSukses and BillCode = 'B'
        and FileName in (select FileName from s_due)""",
    "pool_approved_other": "select * replace (cast(Amount as double) as Amount) from s_other_pool",
    "pool_approved": f"""select {STAGED} from s_mapped where IsSukses and BillCode = 'B' and FileName in (select FileName from s_due)
        union all by name select * replace (cast(Amount as double) as Amount) from s_other_pool""",
    "route_approved": """select id, BillCode, source, 'recurring' as route from s_pool
        union all select id, BillCode, source, route from s_routed""",
    "stage_normalize": """select id, PolisNo, cast(Amount as double) as Amount, TranDate, nullif(ApprovalCode, '') as ApprovalCode,
        nullif(replace(Deskripsi, '''', '*'), '') as Deskripsi, nullif(AccNo, '') as AccNo,
        nullif(replace(AccName, '''', '*'), '') as AccName, IsSukses, IsExec, FileName from fx_upload""",
    "file_already_loaded": "select id, FileName from s_readable where FileName in (select FileName from fx_upload)",
    "sibling_file_loaded": """select c.id from fx_control c where exists (select 1 from fx_control x
        where x.id_billing_download = c.id_billing_download and x.id <> c.id and x.FileName in (select FileName from fx_upload))""",
    "stage_remove_file": f"select {UPLOAD} from fx_upload where FileName not in (select FileName from s_readable where id = 4)",
    "stage_reset": f"""select {UPLOAD} from fx_upload where FileName not in (select FileName from s_readable where id = 1)
        and exists (select 1 from fx_control x join fx_control c on c.id = 1 and x.id <> 1
        and x.id_billing_download = c.id_billing_download join fx_upload u on u.FileName = x.FileName)""",
    "stage_reset_tables": f"""select {UPLOAD}, stageTable from (
        select *, concat('stage_', cast(regexp_extract(FileName, '[0-9]+') as int) % 2) as stageTable from fx_upload)
        where stageTable <> 'stage_0'""",
    "va_drop_paid": """select id, PolisId, TranDate, cast(Amount as double) as Amount from fx_va_upload v where not exists (
        select 1 from fx_billing b where b.policy_id = v.PolisId and b.paid_date = v.TranDate and b.status_billing = 'P')""",
    "release_control": f"""select {CONTROL} from (select * replace (case when id = 4 then null else FileName end as FileName,
        case when id = 4 then null else tglProses end as tglProses) from fx_control)""",
    "upload_counts": f"select *, count_approve + count_reject as total_upload from (select {COUNTS} from s_mapped)",
    "file_row_count": """select c.id, c.FileName, count(u.id) as total_data from fx_control c
        left join fx_upload u on u.FileName = c.FileName group by all""",
    "upload_summary": f"""select s.id, n.count_approve, n.count_reject, n.count_approve + n.count_reject as total_upload
        from fx_upload_sum s cross join (select {COUNTS} from s_mapped) n""",
    "record_row_count": f"""select {CONTROL}, (select count(*) from fx_upload u where u.FileName = c.FileName) as total_data
        from fx_control c""",
    "download_cleared": """select id, case when TotalAmountDWD + TotalCountDWD <= 0 then null else file_download end as file_download,
        cast(TotalAmountDWD as double) as TotalAmountDWD, TotalCountDWD from fx_download_summary""",
    # mapping
    "map_policy": only("B"),
    "map_billing_other": only("A"),
    "map_quote_id": f"""select u.id, u.PolisNo, cast(null as bigint) as PolisId, cast(q.quote_id as varchar) as BillingID,
        case when q.quote_id is not null then 'Q' end as BillCode from fx_upload u
        left join (select distinct quote_id from fx_quote_billing) q on q.quote_id = {SUFFIX} and left(u.PolisNo, 1) = 'X'""",
    "map_quote_ref": only("Q"),
    "map_upload": f"select {STAGED}, IsExec from s_mapped",
    "reason_by_code": "select * from s_coded",
    "reason_by_text": """select c.id, c.ApprovalCode, case when c.RejectGroupID is null then g.RejectReason else c.Deskripsi end as Deskripsi,
        c.IsSukses, coalesce(c.RejectGroupID, g.GroupRejectMappingID) as RejectGroupID
        from s_coded c left join s_general g on g.RejectReason = c.Deskripsi and not c.IsSukses and c.RejectGroupID is null""",
    "reason_at_post": """select u.id, u.ApprovalCode, coalesce(r.RejectReason, u.Deskripsi, u.ApprovalCode) as Deskripsi, u.IsSukses,
        r.GroupRejectMappingID as RejectGroupID from fx_upload u left join s_any_reason r on r.RejectReason = u.Deskripsi
        where not u.IsSukses""",
    "reason_at_post_by_code": """select u.id, u.ApprovalCode, coalesce(r.RejectReason, u.Deskripsi, u.ApprovalCode) as Deskripsi, u.IsSukses,
        r.GroupRejectMappingID as RejectGroupID from fx_upload u left join (
         select RejectCode, RejectReason, GroupRejectMappingID from fx_reason_map
         qualify row_number() over (partition by RejectCode order by GroupRejectMappingID, RejectReason) = 1) r
        on r.RejectCode = u.ApprovalCode where not u.IsSukses""",
    # allocation
    "first_open_bill": """select policy_id, BillingID, cast(recurring_seq as int) as recurring_seq,
        cast(cashless_fee_amount as double) as cashless_fee_amount, freq_payment from s_open
        where k = 1 and policy_id in (select policy_id from fx_policy_billing)""",
    "allocate_approved": """select p.id, p.PolisNo, p.PolisId, cast(p.Amount as double) as Amount, cast(p.k as int) as k,
        b.BillingID as bill_id, cast(b.recurring_seq as int) as recurring_seq, cast(b.TotalAmount as double) as TotalAmount,
        cast(b.cashless_fee_amount as double) as cashless_fee_amount, cast(b.due_dt_pre as timestamp) as due_dt_pre,
        cast(p.Amount - b.TotalAmount as double) as amount_diff
        from (select *, row_number() over (partition by PolisId order by Amount, FileName, id) as k from s_mapped
         where IsSukses and not IsExec and BillCode = 'B') p
        left join s_open b on b.policy_id = p.PolisId and b.k = p.k""",
    "reject_open_bills": "select policy_id, BillingID, cast(recurring_seq as int) as recurring_seq from s_reject_bills",
    "rank_reject_bills": "select policy_id, BillingID, cast(recurring_seq as int) as recurring_seq, seqno from s_reject_bills",
    "rank_rejects": "select FileName, id, PolisId, cast(Amount as double) as Amount, seqno from s_rejects",
    "allocate_rejected": "select * exclude (FileName) replace (cast(Amount as double) as Amount) from s_paired_rejects",
    "unclaimed_open_bill": """select policy_id, BillingID, cast(recurring_seq as int) as recurring_seq from fx_billing
        where status_billing in ('A', 'C') and policy_id in (select policy_id from fx_policy_billing)
        and cast(BillingID as varchar) not in (select BillingID from s_paired_rejects where BillingID is not null)
        qualify row_number() over (partition by policy_id order by recurring_seq, BillingID) = 1""",
    "first_claim": """select * replace (cast(Amount as double) as Amount) from s_other_pool
        qualify row_number() over (partition by BillCode, BillingID order by FileName, id) = 1""",
    "other_unpaid": """select p.id, p.BillingID, o.BillingType, o.policy_id as bill_policy_id, cast(o.TotalAmount as double) as TotalAmount
        from s_other_pool p join fx_billing_others o on o.BillingID = p.BillingID and p.BillCode = 'A' and o.status_billing in ('A', 'C')""",
    "quote_unpaid": """select p.id, p.BillingID from s_other_pool p where p.BillCode = 'Q' and exists (select 1 from fx_quote_billing q
        where cast(q.quote_id as varchar) = p.BillingID and q.status in ('A', 'C'))""",
    # posting
    "ledger_recurring": f"""select tran_id, File_Backup, trancode as TranCode, TranDate, true as IsSuccess, PolisId as PolicyId, BillCode,
        cast(bill_id as varchar) as BillingID, cast(Amount as double) as BillAmount, nullif(ApprovalCode, '') as ApprovalCode,
        nullif(Deskripsi, '') as Description, cast(null as int) as GroupRejectMappingID, nullif(AccNo, '') as accNo,
        coalesce(AccName, '') as accName, {NOW} as DateInsert from s_posted""",
    "receipts": f"""select receipt_id, {NOW} as receipt_date, PolisId as receipt_policy_id, 0 as receipt_fund_type_id,
        'RP' as receipt_transaction_code, cast(Amount - cashless_fee_amount as double) as receipt_amount, source as receipt_source,
        'P' as receipt_status, {NOW} as receipt_payment_date_time, cast(recurring_seq as int) as receipt_seq,
        bankid_receipt as bank_acc_id, cast(due_dt_pre as timestamp) as due_date_pre, bankid as acquirer_bank_id,
        coalesce(freq_payment, 0) as freq_payment, 2000 as created_by from s_posted""",
    "policy_notes": f"""select note_id, PolisId as policy_id, {NOW} as date_tran, concat('RECEIPT INPUT RP (', source, ')') as message,
        2000 as staff_id from s_posted
        union all select fee_note_id, PolisId, {NOW}, upper(concat('RECEIPT INPUT Pengguna Cashless (', source, ')')), 2000
        from s_posted where has_fee
        union all select note_id, bill_policy_id, {NOW}, {other_note('o')}, 1000 from s_other o""",
    "receipt_other_fee": f"""select fee_receipt_id as receipt_other_id, {NOW} as receipt_date, PolisId as policy_id, 3 as receipt_type_id,
        cast(cashless_fee_amount as double) as receipt_amount, source as receipt_source, {NOW} as receipt_payment_date,
        cast(recurring_seq as int) as receipt_seq, bankid_receipt as bank_acc_id, bankid as acquirer_bank_id, receipt_id,
        2000 as created_by from s_posted where has_fee""",
    "card_tx": f"""select p.account_tran_id as policy_cc_tran_id, {TX_HEAD}, p.bankid as acquirer_bank_id,
        {filled_account('cc_no', 'cc_name')}, 2 as status_id, 'APPROVED' as remark, p.receipt_id,
        p.fee_receipt_id as receipt_other_id, {NOW} as created_dt
        from s_posted p left join s_cc a on a.PolicyId = p.PolisId where p.source = 'CC'""",
    "account_tx": f"""select p.account_tran_id as policy_ac_tran_id, {TX_HEAD}, p.bankid as bank_id,
        {filled_account('acc_no', 'acc_name')}, 2 as status_id, p.receipt_id, {NOW} as created_dt, {NOW} as update_dt
        from s_posted p left join s_ac a on a.PolicyId = p.PolisId where p.source = 'AC'""",
    "close_bills": f"""select b.BillingID, b.policy_id, cast(b.recurring_seq as int) as recurring_seq,
        {changed("'P'", 'b.status_billing')} as status_billing, cast(b.TotalAmount as double) as TotalAmount,
        cast(b.cashless_fee_amount as double) as cashless_fee_amount, b.freq_payment, cast(b.due_dt_pre as timestamp) as due_dt_pre,
        {changed("case when p.source <> 'CC' then p.TranDate end", 'b.paid_date')} as paid_date,
        {changed("coalesce(nullif(p.AccNo, ''), nullif(b.AccNo, ''), a.cc_no)", 'b.AccNo')} as AccNo,
        {changed("coalesce(nullif(p.AccName, ''), nullif(b.AccName, ''), a.cc_name)", 'b.AccName')} as AccName,
        cast({changed(f"coalesce(b.BillingDate, {TODAY})", 'b.BillingDate')} as timestamp) as BillingDate,
        b.BankIdDownload, b.Source_download, {changed('false', cast='boolean')} as IsDownload, {changed('true', cast='boolean')} as IsClosed,
        p.source as PaymentSource, p.bankid as BankIdPaid, cast(p.Amount as double) as PaidAmount, p.account_tran_id as CoreTranID,
        p.receipt_id as ReceiptID, p.fee_receipt_id as ReceiptOtherID, p.note_id as policy_note_receipt,
        p.fee_note_id as policy_note_receiptOther, p.tran_id as PaymentTransactionID, {changed(NOW, cast='timestamp')} as LastUploadDate,
        {changed("'system'", cast='varchar')} as UserUpload
        from fx_billing b left join s_posted p on p.bill_id = b.BillingID left join s_cc a on a.PolicyId = b.policy_id""",
    "mark_executed": """select FileName, id, IsExec or (FileName, id) in (select (FileName, id) from s_posted
        union all select (FileName, id) from s_other union all select (FileName, id) from s_quote) as IsExec from s_mapped""",
    "post_billing_other": """select id, BillingID, BillingType, bill_policy_id, cast(Amount as double) as Amount,
        cast(TotalAmount as double) as TotalAmount, CoreTranID, source, tran_id, note_id, receipt_other_id from s_other""",
    "ledger_other": claim_ledger("s_other", "bill_policy_id"),
    "receipt_other_billing": f"""select receipt_other_id, {NOW} as receipt_date, bill_policy_id as policy_id, 1 as receipt_type_id,
        cast(TotalAmount as double) as receipt_amount, source as receipt_source, {NOW} as receipt_payment_date, 0 as receipt_seq,
        bankid_receipt as bank_acc_id, bankid as acquirer_bank_id, {NULL_TEXT} as receipt_id, cast(null as int) as created_by from s_other""",
    "card_tx_changes": f"""select FileName as stage_file, id as stage_id, CoreTranID as policy_cc_tran_id, 2 as status_id, coalesce(ApprovalCode, '') as result_status,
        'APPROVED' as remark, receipt_other_id, {NOW} as update_dt from s_other where CoreTranID is not null""",
    "apply_card_tx_changes": f"""select t.policy_cc_tran_id, t.policy_id, case when p.id is null then t.status_id else 2 end as status_id,
        case when p.id is null then t.remark else 'APPROVED' end as remark,
        case when p.id is null then t.result_status else coalesce(p.ApprovalCode, '') end as result_status,
        cast(t.total_amount as double) as total_amount, p.receipt_other_id, case when p.id is not null then {NOW} end as update_dt
        from fx_card_transaction t left join (select * from s_other where CoreTranID is not null
         qualify row_number() over (partition by CoreTranID order by FileName desc, id desc) = 1) p on p.CoreTranID = t.policy_cc_tran_id""",
    "apply_quote_changes": f"""
        select 'quote' as table_name, q.quote_id, {NULL_TEXT} as code, case when p.id is not null then 'P' end as status,
         case when p.id is not null then {NOW} end as changed, cast(null as int) as bank
        from fx_quote q left join s_quote p on p.quote_id = q.quote_id
        union all select 'prospect', q.quote_id, case when p.id is not null then 'UP4Y1' end,
         case when p.id is null then cast(q.prospect_convert_flag as varchar) else '2' end, case when p.id is not null then {NOW} end, p.bankid
        from fx_prospect q left join s_quote p on p.quote_id = q.quote_id
        union all select 'quote_terminal', q.quote_id, case when p.id is not null then 'UP4Y1' end,
         case when p.id is null then concat(q.status_id, ':', q.reason) else '1:' end, null, null
        from fx_quote_terminal q left join s_quote p on p.quote_id = q.quote_id""",
    "close_billing_others": f"""select o.BillingID, o.policy_id, o.BillingType, {changed("'P'", 'o.status_billing')} as status_billing,
        cast(o.TotalAmount as double) as TotalAmount, o.CoreTranID, {changed('false', cast='boolean')} as IsDownload,
        {changed('true', cast='boolean')} as IsClosed, {changed("'CC'", cast='varchar')} as PaymentSource, {NULL_TEXT} as Source_download,
        {changed(NOW, cast='timestamp')} as paid_date, p.bankid as BankIdPaid, cast(p.Amount as double) as PaidAmount,
        p.receipt_other_id as ReceiptOtherID, p.note_id as policy_note_receiptOther, p.tran_id as PaymentTransactionID,
        {changed(NOW, cast='timestamp')} as LastUploadDate, {changed("'system'", cast='varchar')} as UserUpload
        from fx_billing_others o left join s_other p on p.BillingID = o.BillingID""",
    "post_quote": "select id, BillingID, quote_id, cast(Amount as double) as Amount, source, tran_id from s_quote",
    "ledger_quote": claim_ledger("s_quote", "cast(null as bigint)"),
    "quote_changes": f"""select FileName as stage_file, id as stage_id, quote_id, 'P' as quote_status, {NOW} as quote_submitted_dt, 2 as prospect_convert_flag,
        'UP4Y1' as prospect_appr_code, {NOW} as updated_dt, bankid as acquirer_bank_id, 1 as status_id, '' as reason,
        'UP4Y1' as appr_code from s_quote""",
    "close_quotes": f"""select q.quote_id, q.ref_no, {changed("'P'", 'q.status')} as status, q.Holder_Name, q.product_id,
        cast(q.cashless_fee as double) as cashless_fee, cast(q.prospect_amount as double) as prospect_amount,
        {changed('false', cast='boolean')} as IsDownload, {changed('true', cast='boolean')} as IsClosed,
        {changed("'CC'", cast='varchar')} as PaymentSource, {NULL_TEXT} as Source_download, {changed(NOW, cast='timestamp')} as paid_dt,
        cast(null as int) as BankIdPaid, cast(p.Amount as double) as PaidAmount, p.tran_id as PaymentTransactionID,
        {changed(NOW, cast='timestamp')} as LastUploadDate, {changed("'system'", cast='varchar')} as UserUpload
        from fx_quote_billing q left join s_quote p on p.quote_id = q.quote_id""",
    "post_approved": f"""select output, row_key, cast(amount as double) as amount from (
        select 'ledger' as output, tran_id as row_key, Amount as amount from s_posted
        union all select 'ledger', tran_id, Amount from s_other union all select 'ledger', tran_id, Amount from s_quote
        union all select 'receipt', receipt_id, Amount - cashless_fee_amount from s_posted
        union all select 'receipt_other', fee_receipt_id, cashless_fee_amount from s_posted where has_fee
        union all select 'receipt_other', receipt_other_id, TotalAmount from s_other
        union all select 'note', note_id, null from s_posted union all select 'note', fee_note_id, null from s_posted where has_fee
        union all select 'note', note_id, null from s_other
        union all select 'card_tx', account_tran_id, TotalAmount from s_posted where source = 'CC'
        union all select 'account_tx', account_tran_id, TotalAmount from s_posted where source = 'AC'
        union all select 'card_tx_change', receipt_other_id, null from s_other where CoreTranID is not null
        union all select 'quote_change', cast(quote_id as varchar), null from s_quote
        union all select 'email', concat(FileName, ':', id), null from s_posted
        union all select 'email', concat(FileName, ':', id), null from s_other
        union all select 'email', concat(FileName, ':', id), null from s_quote
        union all select 'error', concat(FileName, ':', id), null from s_errors)""",
    "post_errors": "select * from s_errors",
    # rejects
    "ledger_rejected": f"select {LEDGER} from s_reject_ledger",
    "touch_bills": f"""select b.BillingID, b.status_billing, {changed('false', cast='boolean')} as IsDownload,
        {changed(NOW, cast='timestamp')} as LastUploadDate, p.tran_id as PaymentTransactionID,
        {changed('coalesce(b.BankIdDownload, p.bankid)', 'b.BankIdDownload')} as BankIdDownload,
        {changed('coalesce(b.Source_download, p.source)', 'b.Source_download')} as Source_download,
        cast({changed(f'coalesce(b.BillingDate, {TODAY})', 'b.BillingDate')} as timestamp) as BillingDate
        from fx_billing b left join s_touch p on p.BillCode = 'B' and p.BillingID = cast(b.BillingID as varchar) and b.status_billing in ('A', 'C')""",
    "touch_others": f"""select o.BillingID, o.status_billing, {changed('false', cast='boolean')} as IsDownload,
        {changed(NOW, cast='timestamp')} as LastUploadDate, p.tran_id as PaymentTransactionID, {changed("'CC'", cast='varchar')} as Source_download
        from fx_billing_others o left join s_touch p on p.BillCode = 'A' and p.BillingID = o.BillingID and o.status_billing in ('A', 'C')""",
    "touch_quotes": f"""select q.quote_id, q.status, {changed('false', cast='boolean')} as IsDownload,
        {changed(NOW, cast='timestamp')} as LastUploadDate, p.tran_id as PaymentTransactionID, {changed("'CC'", cast='varchar')} as Source_download
        from fx_quote_billing q left join s_touch p on p.BillCode = 'Q' and p.BillingID = cast(q.quote_id as varchar) and q.status in ('A', 'C')""",
    "post_rejected": f"""select {key('ledger_rejected', 'm')} as tran_id, c.FileName as File_Backup, c.trancode as TranCode,
        cast(null as timestamp) as TranDate, false as IsSuccess, m.PolisId as PolicyId, m.BillCode, x.BillingID,
        cast(m.Amount as double) as BillAmount, m.ApprovalCode, coalesce(rp.RejectReason, m.Deskripsi, m.ApprovalCode) as Description,
        rp.GroupRejectMappingID, m.AccNo as accNo, m.AccName as accName, {NOW} as DateInsert
        from s_mapped m join s_late_bill x on x.id = m.id and x.FileName = m.FileName join s_readable c on c.FileName = m.FileName
        left join s_any_reason rp on rp.RejectReason = m.Deskripsi""",
    "hold_rejected": f"""select coalesce(h.policy_id, f.PolisId) as policy_id,
        cast(case when f.PolisId is null or h.ReleaseDate > {TODAY} + 15 then h.ReleaseDate else {TODAY} + 15 end as timestamp) as ReleaseDate,
        case when f.PolisId is null or h.ReleaseDate > {TODAY} + 15 then h.Description
         else 'Auto Hold, Reject Debet AC  Recurring' end as Description,
        case when h.policy_id is null then 'system' end as UserCrt,
        case when f.n_failed > 1 or (h.policy_id is not null and f.n_failed > 0) then {NOW} end as DateUpdate,
        case when f.n_failed > 1 or (h.policy_id is not null and f.n_failed > 0) then 'system' end as UserUpdate
        from fx_billinghold h full join s_failed_policies f on f.PolisId = h.policy_id""",
    # notifications
    "email_recurring": f"select {mail(FOUND, 'ci.Email', TEXTS.recurring, **PERSON)} from s_posted p {PEOPLE.format('p.PolisId')}",
    "email_other": f"""select {mail(FOUND, 'ci.Email', TEXTS.other, **PERSON, type=OTHER_TYPE)} from s_other p
        {PEOPLE.format('p.bill_policy_id')}""",
    "email_quote": "select " + mail(
        "(b.quote_id is not null and q.quote_id is not null and pd.product_id is not null)", "q.email", TEXTS.quote,
        title="case when q.IsLaki then 'Bapak' else 'Ibu' end", name="upper(b.Holder_Name)", ref="b.ref_no",
        sex="case when q.IsLaki then 'Pria' else 'Wanita' end", birthplace="q.POB", birthdate="strftime(q.DOB, '%d %b %Y')",
        email="q.email", mobile="q.mobile_phone", product="pd.product_description", insured=whole("q.sum_insured"),
        years="cast(q.duration as varchar)", days="cast(q.duration_days as varchar)", premium=whole("b.prospect_amount"),
        fee=whole("b.cashless_fee"), mode=MODE, method="q.payment_method",
    ) + """ from s_quote p left join fx_quote_billing b on b.quote_id = p.quote_id left join fx_quote q on q.quote_id = p.quote_id
        left join fx_product pd on pd.product_id = b.product_id""",
}


def oracle_sql() -> dict[str, str]:
    return {name: with_views(sql, STEPS) for name, sql in FINAL.items()}
