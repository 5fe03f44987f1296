"""The registered queries as SQL over the raw test tables, for a second engine."""

from __future__ import annotations

from daybook import schemas

CARD_TYPES = "('click', 'error')"
TYPES = ["click", "error", "purchase", "signup", "view"]


def day(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%dT00:00:00')"


def money(x: str) -> str:
    return f"cast({x} as decimal(18,2))"


AGGREGATES = {
    1: "count(*)", 2: f"sum({money('value')})", 3: f"min({money('value')})", 4: f"max({money('value')})",
    5: "min(event_id)", 6: "max(event_id)", 30: "max(user_id % 26)",
    **{i: f"count(case when event_type = '{t}' then 1 end)" for i, t in enumerate(TYPES, 7)},
}


def _values() -> str:
    return ", ".join(
        f"cast({AGGREGATES.get(i, f'(min(event_id) + max(event_id) * {i}) % 1000')} as varchar) as value{i}"
        for i in range(1, 56)
    )


VIEWS = {
    "att": f"""select *, empid || '-' || substr(date, 1, 10) as recordid from (
        select cast(user_id as varchar) as empid, {day('ts')} as date,
               strftime(max(ts), '%Y-%m-%d %H:%M:%S') as updatetime, {_values()}
        from events group by 1, 2)""",
    "rec": f"""select cast(user_id as varchar) as empid, {day('ts')} as signdate, event_type as shiftcode
        from events where event_type in {CARD_TYPES}""",
    "work": """select distinct event_type as shiftcode, event_type || ' shift' as shiftname
        from events where event_type <> 'error'""",
    "people": f"""select cast(c_custkey as varchar) as empid,
        case when c_acctbal >= 0 then cast(c_custkey as varchar) end as empnum,
        c_mktsegment as emprank, c_name as empname,
        case when c_mktsegment = 'HOUSEHOLD' then 'X' || c_nationkey else cast(c_nationkey as varchar) end as empdept,
        case when c_acctbal > 5000 then 'fixed' else 'flex' end as atttype,
        case when c_custkey % 5 <> 0 then {day("date '2024-01-01' + to_days(cast(c_custkey % 20 as int))")} end as entrydate,
        case when c_custkey % 3 = 0 then {day("date '2024-01-15' + to_days(cast(c_custkey % 10 as int))")} end as leavedate,
        case when c_custkey % 2 = 0 then 'true' when c_mktsegment = 'BUILDING' then 'n/a' else 'false' end as isleave
        from customer""",
    "days": """select unnest(generate_series(date_trunc('day', min(ts)) + interval 2 day,
        date_trunc('day', max(ts)), interval 1 day)) as d from events""",
    "snap": f"select people.*, {day('d')} as date from people cross join days",
    "emp": """select empid, empnum, emprank, empname, empdept, atttype, entrydate, leavedate, date,
        case when entrydate <= date and leavedate is null then false
             when entrydate <= date and leavedate > date then false
             when entrydate >= date or leavedate <= date then true
             else try_cast(isleave as boolean) end as isleave from snap""",
    "dept0": """select cast(n_nationkey as varchar) as deptcode, n_name as deptnamel1,
        case when n_regionkey % 2 = 0 then '' else n_name end as deptnamel2,
        case when n_regionkey = 1 then '' else 'sub_' || n_name end as deptnamel3,
        '' as deptnamel4, cast(null as varchar) as deptnamel5 from nation""",
    "dept": """select deptcode, deptnamel1, nullif(deptnamel2, '') as deptnamel2, nullif(deptnamel3, '') as deptnamel3,
        nullif(deptnamel4, '') as deptnamel4, nullif(deptnamel5, '') as deptnamel5 from dept0""",
    "units": """select case when n_regionkey = 4 then 'U' || n_nationkey else cast(n_nationkey as varchar) end as fnumber,
        cast(n_regionkey + 1 as varchar) as forgfunctionid, cast(n_regionkey - 1 as varchar) as freserveitemfirst,
        'L' || n_nationkey as flongnumber, 'S' || n_nationkey as fsortcode,
        'root_' || n_name as fdisplayname_l2 from nation""",
    "funcs": "select cast(r_regionkey as varchar) as fid, r_name as fname_l2, 'F' || r_regionkey as fnumber from region",
    "cats": "select cast(r_regionkey as varchar) as fid, lower(r_name) as fname_l2, 'C' || r_regionkey as fnumber from region",
    "org": """select units.fnumber, fdisplayname_l2, funcs.fname_l2 as systemcategory, funcs.fnumber as systemnumber,
        cats.fname_l2 as companycategory, cats.fnumber as companynumber, flongnumber, fsortcode
        from units left join funcs on forgfunctionid = funcs.fid left join cats on freserveitemfirst = cats.fid""",
}
NEEDS = {
    "snap": ["people", "days"], "emp": ["snap"], "dept": ["dept0"],
    "org": ["units", "funcs", "cats"],
}


def with_views(names: list[str], sql: str, extra: dict[str, str] | None = None) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    parts = [f"{n} as ({VIEWS[n]})" for n in ordered]
    parts += [f"{n} as ({body})" for n, body in (extra or {}).items()]
    return f"with {', '.join(parts)} {sql}" if parts else sql


def _qualified(values: int) -> str:
    source = {"shiftcode": "rec", "shiftname": "work"}
    source |= {c: "emp" for c in schemas.EMPLOYEE_COLUMNS}
    source |= {c: "dept" for c in schemas.DEPARTMENT_COLUMNS}
    source |= {c: "org" for c in schemas.ORG_COLUMNS}
    return ", ".join(f"{source.get(c, 'att')}.{c}" for c in schemas.wide_columns(values))


def _wide(values: int = schemas.VALUE_COUNT, code: str = "emp.empdept") -> str:
    return f"""select {_qualified(values)} from att
        left join rec on att.empid = rec.empid and att.date = rec.signdate
        left join work on rec.shiftcode = work.shiftcode
        left join emp on emp.empid = att.empid and emp.date = att.date
        left join dept on {code} = dept.deptcode
        left join org on dept.deptcode = org.fnumber
        where emp.empnum is not null"""


WIDE_VIEWS = ["att", "rec", "work", "emp", "dept", "org"]

# Table maintenance: stale events by day, fresh events without one day.
DAYS = {
    "d": f"select event_id, event_type, value, {day('ts')} as date from events",
    "old": "select event_id, 'stale' as event_type, cast(0.0 as double) as value, date from d",
    "fresh": "select * from d where date <> '2024-01-17T00:00:00'",
}


def replaced(inside: str) -> str:
    return with_views([], f"""select * from old where not ({inside})
        union all select * from fresh where {inside}""", DAYS)


def between(low: str, high: str, column: str = "date") -> str:
    return f"{column} between '{low}T00:00:00' and '{high}T00:00:00'"


PENDING = {
    "p": """select cast(o_orderkey as varchar) as leavecode, o_orderstatus as deptcode,
        o_totalprice as hours from orders""",
}
PENDING_A = "deptcode = 'P'"
PENDING_B = "(deptcode <> 'F' and hours > 250000)"

ORDERS_OLD = "o_orderdate < timestamp '2000-01-01'"
SPANS = {
    "spans": """select o_custkey, date_trunc('day', min(o_orderdate)) as low,
        date_trunc('day', max(o_orderdate)) as high from orders group by o_custkey""",
}
TRIM = r"'^[\x00-\x20]+|[\x00-\x20]+$'"


def clean(x: str) -> str:
    return rf"nullif(regexp_replace(regexp_replace({x}, '[\n\r\t]', ' ', 'g'), {TRIM}, '', 'g'), 'null')"


# The scrub patterns, in order.
SCRUB_PATTERNS = [
    (r"t\$(date|full|conf|user)", r"t_\1"),
    (r"T\$(DATE|FULL|CONF|USER)", r"T_\1"),
    (r"[tT]\$", ""),
    (r"\$", "_"),
    (r"[\n\r\t]", ""),
    (r':" *(\S+?) *"', r':"\1"'),
    (r':""', r':"null"'),
]


def scrub(x: str) -> str:
    for pattern, to in SCRUB_PATTERNS:
        x = f"regexp_replace({x}, '{pattern}', '{to}', 'g')"
    return x


NEW_ORDERS = f"""select o_orderkey as orderkey, o_orderstatus as status,
    case when {ORDERS_OLD} then o_orderpriority else nullif(o_orderpriority, '5-LOW') end as order_priority,
    o_orderdate as t_date from orders
    where {ORDERS_OLD} or o_orderdate > (select max(o_orderdate) from orders where {ORDERS_OLD})"""

SNAPSHOT_COLUMNS = "empid, empnum, emprank, empname, empdept, atttype, entrydate, leavedate, isleave, date"
STALE_COLUMNS = SNAPSHOT_COLUMNS.replace("empname", "'stale' as empname")


def snapshots_from(low: str, days: int) -> str:
    return with_views(["people"], f"""select {STALE_COLUMNS} from people,
            (values ('2024-01-24T00:00:00'), ('2024-01-25T00:00:00')) t(date) where date < '{low}T00:00:00'
        union all select {SNAPSHOT_COLUMNS} from people, (select {day('d')} as date from
            (select unnest(generate_series(timestamp '{low}', timestamp '{low}' + interval {days - 1} day,
             interval 1 day)) as d))""")


ITEMS = """select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as ts, user_id, event_type, value, props
    from events"""


def _tiers() -> str:
    names = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
             "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
    counts = " union all ".join(f"select count(*) as n_rows, '{n}' as table_name from {n}" for n in names)
    return f"""select n_rows, table_name, cast(case when n_rows < 10000 then 1 when n_rows < 1000000 then 10
        when n_rows < 10000000 then 100 when n_rows < 20000000 then 500
        else greatest(1000, ceil(n_rows / 20000)) end as int) as partitions
        from ({counts})"""


UPSERTED = f"""with new as (select nullif(o_custkey, 10) as c_custkey,
            cast(sum({money('o_totalprice')}) as double) as balance from orders group by 1),
        old as (select nullif(c_custkey, 10) as c_custkey, c_acctbal as balance from customer)
        select * from old where not exists (
            select 1 from new where new.c_custkey is not distinct from old.c_custkey)
        union all select * from new"""

ORACLE: dict[str, str] = {
    "wide_record_current": with_views(WIDE_VIEWS, _wide()),
    "wide_record_bucketed": with_views(WIDE_VIEWS, _wide()),
    "wide_record_history": with_views(WIDE_VIEWS, _wide(schemas.HISTORY_VALUE_COUNT, "att.value30")),
    "wide_record_refresh": with_views(WIDE_VIEWS, f"""select * replace ('stale' as empname) from w
        where not ({between('2023-12-06', '2024-01-24')})
        union all select * from w where {between('2023-12-06', '2024-01-24')}""", {"w": _wide()}),
    "org_dimension": with_views(["org"], "select * from org"),
    "default_label_observed": with_views(
        ["org"], "select fnumber, systemcategory, companycategory from org"),
    "default_label_intended": with_views(["org"], """select fnumber,
        coalesce(systemcategory, 'other') as systemcategory,
        coalesce(companycategory, 'other') as companycategory from org"""),
    "employment_status_asof": with_views(
        ["emp"], "select empid, date, entrydate, leavedate, isleave from emp"),
    "composite_key_left_join": with_views(["att", "rec"], """select att.empid, att.date, value1, shiftcode
        from att left join rec on att.empid = rec.empid and att.date = rec.signdate"""),
    "chained_lookup_join": with_views(["att", "rec", "work"], """select att.empid, att.date, value1,
        rec.shiftcode, shiftname from att
        left join rec on att.empid = rec.empid and att.date = rec.signdate
        left join work on rec.shiftcode = work.shiftcode"""),
    "snapshot_join": with_views(["att", "emp"], """select att.empid, att.date, value1, empdept, empnum,
        emprank, empname, isleave, atttype from att
        left join emp on att.empid = emp.empid and att.date = emp.date"""),
    "snapshot_join_intervals": with_views(["att", "emp"], """select att.empid, att.date, value1, empdept, empnum,
        emprank, empname, isleave, atttype from att
        left join emp on att.empid = emp.empid and att.date = emp.date"""),
    "known_member_filter": with_views(["att", "emp"], """select att.empid, att.date, value1, empdept, empnum,
        emprank, empname, isleave, atttype from att
        left join emp on att.empid = emp.empid and att.date = emp.date where empnum is not null"""),
    "org_name_fallback": with_views(["people", "dept", "org"], """select empid, deptcode, deptnamel1, deptnamel2, """
        + ", ".join(
            f"case when by_code.fnumber is not null then coalesce(by_code.{c}, by_name.{c}) else by_name.{c} end as {c}"
            for c in schemas.ORG_COLUMNS)
        + """ from people left join dept on empdept = deptcode
        left join org by_code on deptcode = by_code.fnumber
        left join org by_name on by_code.fnumber is null
            and concat_ws('_', 'root', deptnamel1, deptnamel2) = by_name.fdisplayname_l2"""),
    "narrow_view": with_views(
        WIDE_VIEWS, f"select {', '.join(schemas.NARROW_COLUMNS)} from w", {"w": _wide()}),
    "date_window_filter": with_views(["att", "rec"], f"""select 'fact' as kind, empid, date from att
        where {between('2023-12-06', '2024-01-24')}
        union all select 'card', empid, signdate from rec where {between('2023-12-06', '2024-01-24', 'signdate')}"""),
    "one_day_filter": with_views([], "select * from d where date = '2024-01-24T00:00:00'", DAYS),
    "open_ended_filter": with_views([], "select * from d where date >= '2024-01-11T00:00:00'", DAYS),
    "blank_to_null": with_views(["people", "dept"], """select empid, deptnamel2, deptnamel3, deptnamel4,
        deptnamel5 from people left join dept on empdept = deptcode"""),
    "normalize_code": """select event_id, case upper(c) when 'NORM ' then 'NORM' else upper(c) end as shiftcode
        from (select event_id, case event_type when 'click' then 'norm ' when 'view' then 'Norm  '
              when 'error' then null else event_type end as c from events)""",
    "rename_map": f"""select 'c1' as companycode, o_orderstatus as deptcode, o_orderpriority as officecode,
        cast(o_custkey as varchar) as empnum, 'm' || o_custkey as mailnum, {day('o_orderdate')} as "start",
        {day('o_orderdate + interval 3 day')} as "end", cast(o_orderkey as varchar) as leavecode from orders""",
    "union_of_filters": with_views([], f"""select * from p where {PENDING_A}
        union all select * from p where {PENDING_B}""", PENDING),
    "or_filter": with_views([], f"select * from p where {PENDING_A} or {PENDING_B}", PENDING),
    "preview": "select * from orders order by o_orderkey limit 10",
    "aligned_append": with_views([], "select * from old union all select * from fresh", DAYS),
    "full_overwrite": "select * from customer",
    "full_refresh": with_views([], "select * from fresh", DAYS),
    "full_refresh_typed_keys": """select l_orderkey, l_linenumber, l_linestatus,
        cast(year(l_shipdate) as int) as year, nullif(l_returnflag, 'N') as flag from lineitem""",
    "replace_all_rows": "select * from customer where c_mktsegment <> 'BUILDING'",
    "partition_replace": replaced(between("2023-12-24", "2024-01-24")),
    "partition_replace_recovered": replaced(between("2023-12-24", "2024-01-24")),
    "partition_replace_one_day": replaced("date = '2024-01-24T00:00:00'"),
    "current_day_refresh": replaced("date = '2024-01-25T00:00:00'"),
    "current_day_refresh_stream": replaced("date = '2024-01-25T00:00:00'"),
    "current_day_refresh_offsets": replaced("date = '2024-01-25T00:00:00'"),
    "current_day_refresh_two_pulls": replaced("date = '2024-01-25T00:00:00'"),
    "observed_partition_replace": with_views([], """select * from old
        where date not in (select date from fresh where date >= '2024-01-11T00:00:00')
        union all select * from fresh where date >= '2024-01-11T00:00:00'""", DAYS),
    "month_partition_replace": """with r as (select o_orderkey, o_orderstatus,
            strftime(o_orderdate, '%Y%m') as ym from orders)
        select o_orderkey, 'stale' as o_orderstatus, ym from r where ym not between '199806' and '199809'
        union all select * from r where ym between '199806' and '199809' and ym <> '199807'""",
    "range_backfill": replaced(between("2024-01-10", "2024-01-20")),
    "month_range_backfill": replaced(between("2023-11-20", "2024-01-22")),
    "snapshot_stamp": snapshots_from("2024-01-25", 1),
    "snapshot_backfill": snapshots_from("2024-01-25", 7),
    "snapshot_intervals": f"select * from ({snapshots_from('2024-01-25', 7)}) where date <> '2024-01-28T00:00:00'",
    "derived_partitions_year": "select *, cast(year(l_shipdate) as int) as year from lineitem",
    "derived_partitions_month": """select *, cast(year(o_orderdate) as int) as year,
        cast(month(o_orderdate) as int) as month from orders""",
    "derived_partitions_day": """select *, cast(year(ts) as int) as year, cast(month(ts) as int) as month,
        cast(day(ts) as int) as day from events""",
    "upsert_by_key": UPSERTED,
    "upsert_merge_on_read": UPSERTED,
    "delta_watermark": "select strftime(max(ts), '%Y-%m-%d %H:%M:%S') as watermark from events",
    "partition_row_count": with_views(
        [], "select count(*) as n_rows from d where date = '2024-01-25T00:00:00'", DAYS),
    "distinct_partitions": with_views([], "select distinct date from d", DAYS),
    "delta_t0": f"""select * from orders where o_orderdate >
        (select max(o_orderdate) from orders where {ORDERS_OLD})""",
    "delta_t0_from_statistics": """select * from orders where o_orderdate >
        (select max(o_orderdate) from orders where o_orderdate < timestamp '1998-04-01')""",
    "delta_t1": "select * from events where ts >= timestamp '2024-01-24' and ts < timestamp '2024-01-25'",
    "delta_range": """select * from lineitem
        where l_shipdate >= timestamp '1997-01-01' and l_shipdate < timestamp '1998-01-01'""",
    "delta_resume_by_count": f"""select * replace (nullif(o_custkey, 10) as o_custkey)
        from orders where not ({ORDERS_OLD}) or o_orderdate is null""",
    "load_full": "select * from orders",
    "load_fullpart": "select *, cast(year(o_orderdate) as int) as year from orders",
    "load_delta": NEW_ORDERS,
    "load_delta_keyed": """select o_custkey as custkey, max(o_orderkey) as orderkey,
            max_by(o_orderstatus, o_orderkey) as status from orders group by o_custkey
        union all select c_custkey, 0, 'none' from customer
        where c_custkey not in (select o_custkey from orders)""",
    "load_deltapart": f"select *, cast(year(t_date) as int) as year from ({NEW_ORDERS})",
    "safe_union": """select event_id as id, ts, user_id, cast(null as double) as price from events
        union all select o_orderkey, o_orderdate, null, o_totalprice from orders""",
    "safe_union_epoch": """select event_id as id,
        strftime(date_trunc('second', t) - interval 8 hour, '%Y-%m-%d %H:%M:%S') as ts
        from (select event_id, unnest([ts, ts - interval 25 year, ts - interval 65 year]) as t from events)
        union all select o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') from orders""",
    "page_union_skip_empty": with_views([], "select * from d", DAYS),
    "sequential_id": "select *, row_number() over (order by user_id, event_id) as row_id from events",
    "clean_schema_names": """select o_orderkey as orderkey, o_orderstatus as status,
        o_totalprice as pricetotal, o_orderdate as orderdate from orders""",
    "lower_schema": "select * from customer",
    "vendor_names": """select l_shipdate as t_date, l_orderkey as t_dates, l_linenumber as amt,
        l_returnflag as a_b, l_linestatus as amounx from lineitem""",
    "clean_string_values": f"""select doc_id, {clean('text')} as text,
        {clean("chr(9) || chr(1) || ' ' || text || ' ' || chr(1) || chr(13) || chr(10)")} as padded,
        {clean("case when lang = 'fr' then ' null' || chr(10) else source end")} as source from documents""",
    "raw_json_scrub": "select doc_id, " + scrub(
        """'{"t$user":" ' || lang || ' ","T$FULL":"' || source || '  ","amt$x":"","t$body":" ' || text || '"}'"""
    ) + " as scrubbed from documents",
    "cast_to_target": """select cast(o_orderkey as varchar) as o_orderkey, o_custkey, o_orderstatus, o_totalprice,
        cast(o_orderdate as date) as o_orderdate, try_cast(o_orderpriority as int) as o_orderpriority from orders""",
    "cast_by_type_map": f"""select l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d') as shipped,
        cast({money('l_extendedprice')} as double) as price from lineitem""",
    "cast_by_type_name": f"""select cast(l_orderkey as varchar) as l_orderkey,
        cast(l_linenumber as bigint) as l_linenumber, cast(l_quantity as int) as l_quantity,
        {money('l_extendedprice')} as l_extendedprice, try_cast(l_returnflag as double) as l_returnflag
        from lineitem""",
    "column_comments": r"""select 'c' || doc_id as column_name,
        coalesce(trim(regexp_replace(text, '[\r\n\t]', ',', 'g')), '') as comment
        from documents where lower(source) = 'src1' and lang = 'en'
        union all select 'n' || doc_id, '' from documents where lower(source) = 'src1' and lang = 'en'""",
    "date_series": f"""select o_orderkey, {day('d')} as day from (select o_orderkey,
        unnest(generate_series(date_trunc('day', o_orderdate), date_trunc('day', o_orderdate)
        + to_days(cast(substr(o_orderpriority, 1, 1) as int) - 2), interval 1 day)) as d from orders)""",
    "last_n_days": with_views([], f"""select o_custkey, {day('d')} as day from (select o_custkey,
        unnest(generate_series(high - interval 32 day, high - interval 1 day, interval 1 day)) as d
        from spans)""", SPANS),
    "month_series": with_views([], """select o_custkey, strftime(d, '%Y%m') as ym from (select o_custkey,
        unnest(generate_series(date_trunc('month', low), date_trunc('month', high), interval 1 month)) as d
        from spans)""", SPANS),
    "month_ranges": f"""with recursive spans as ({SPANS['spans']}), steps as (
            select o_custkey, low as s, high from spans
            union all select o_custkey, s + interval 1 month + interval 1 day, high from steps
            where s + interval 1 month + interval 1 day <= high)
        select o_custkey, strftime(s, '%Y-%m-%d') as start_date,
            strftime(least(s + interval 1 month, high), '%Y-%m-%d') as end_date from steps""",
    "request_grid": f"""with days as (select c_nationkey as company_id, date_trunc('day', min(o_orderdate)) as low,
            date_trunc('day', max(o_orderdate)) as high from orders join customer on o_custkey = c_custkey group by 1)
        select company_id, {day('d')} as from_date, {day('d + interval 59 day')} as to_date from (
            select company_id, unnest(generate_series(low, high - interval 1 day, interval 60 day)) as d from days)""",
    "date_helpers": f"""select event_id, strftime(ts, '%Y-%m-%d') as today,
        strftime(ts - interval 1 day, '%Y-%m-%d') as yesterday,
        strftime(ts + interval 1 day, '%Y-%m-%d') as tomorrow,
        strftime(ts + interval 1 day, '%Y-%m-%d') as next_day,
        strftime(ts + interval 59 day, '%Y-%m-%d') as later_day,
        strftime(date_trunc('hour', ts), '%Y-%m-%d %H:00:00') as hour,
        case when event_type = 'error' then 'null' else strftime(ts, '%Y-%m-%d %H:%M:%S') end as clock,
        (epoch_us(ts) - epoch_us(date_trunc('day', ts))) // 1000 as millis,
        strftime(date_trunc('day', ts) + interval 7 hour + interval 30 minute + interval 5 second,
            '%Y-%m-%d %H:%M:%S') as start_time from events""",
    "page_json_ingest": ITEMS,
    "page_json_ingest_get": ITEMS,
    "paged_source": f"select *, substr(ts, 1, 10) as date from ({ITEMS})",
    "paged_source_get": f"""select *, substr(ts, 1, 10) as date from ({ITEMS})
        where substr(ts, 1, 10) between '2024-01-10' and '2024-01-20'""",
    "page_count_check": """select case page % 3 when 0 then held when 1 then held + 1 end as declared, held,
            page % 3 <> 1 as complete, count(*) as n_pages
        from (select event_id // 500 as page, cast(count(*) as int) as held from events group by 1)
        group by all""",
    "page_quarantine": """select event_id // 500 as page, case when event_id // 500 % 5 = 0 then count(*) else 0 end as n_rows,
            case event_id // 500 % 5 when 0 then 'loaded' when 1 then 'not valid JSON'
                when 2 then 'another number of rows than its count' when 3 then 'values of other types'
                else 'no array of rows' end as reason
        from events group by event_id // 500""",
    "page_schema_drift": """select event_id, case when event_id % 3 < 2 then strftime(ts, '%Y-%m-%d %H:%M:%S.%f') end as ts,
            case when event_id % 3 < 2 or user_id % 2 = 1 then user_id end as user_id,
            case when event_id % 3 > 0 then value end as value, case when event_id % 3 = 1 then event_type end as kind,
            case when event_id % 3 = 2 and user_id % 2 = 0 then 'u' || user_id end as rescued from events""",
    "landing_to_table": "select doc_id as docid, text, lang from documents",
    "jdbc_slice_predicates": """select o_orderkey, 1 as n_slices,
        cast(case when o_custkey = 7 then 0 else cast(floor(abs(o_custkey - 499.75)) as bigint) % 10 end as int) as slice from orders""",
    "jdbc_delta_condition": """select * from events
        where ts >= timestamp '2024-01-24' and ts < timestamp '2024-01-25'""",
    "size_tier": _tiers(),
    "job_audit": """select 'orders' as table_name, '1' as status, 'update success' as info, true as ended,
            count(*) as n_rows from orders
        union all select 'broken', '0', 'the source didn''t answer', false, null""",
    "dependent_loads": """select 'lineitem' as table_name, '1' as status, count(*) as n_rows from lineitem
        union all select 'orders', '1', count(*) from orders union all select 'customer', '1', count(*) from customer
        union all select 'items', '1', count(*) from lineitem join orders on l_orderkey = o_orderkey
        union all select 'buyers', '1', count(*) from orders join customer on o_custkey = c_custkey
        union all select 'part', '0', null union all select 'open_items', '2', null""",
    "multi_table_load": """select 'customer' as table_name, '1' as status, count(*) as n_rows from customer
        union all select 'orders', '1', count(*) from orders union all select 'part', '1', count(*) from part
        union all select 'lineitem', '1', count(*) from lineitem union all select 'broken', '0', null""",
}
