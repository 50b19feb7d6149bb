"""The same results in plain SQL, written against the base tables and without the rewrites.

Joins are literal OR conditions here, and one master row per firm is picked with a window. Each
query is a final SELECT over named building blocks; only the blocks it mentions are included.
"""

from __future__ import annotations

import re

from ..functions import vocabulary as v
from ..sources.fixtures import RUN_TS, TRANSACTIONS

TS = f"timestamp '{RUN_TS}'"
IDS = ", ".join(v.ID_COLS)
PAYLOAD = ", ".join(v.PAYLOAD_COLS)
STATUSES = "('EXACT_MATCH','PAYER_ID_ONLY','NAME_ONLY')"
REVIEW = "('PAYER_ID_ONLY','NAME_ONLY')"
ANY_NULL = "(payer_id_fac is null or payer_id_pro is null or payer_id_elig is null)"
ALL_NULL = "coalesce(payer_id_fac, payer_id_pro, payer_id_elig) is null"
NEW_ID = "coalesce(payer_id_fac, payer_id_pro, payer_id_elig)"


def lit(text) -> str:
    return "null" if text is None else "'" + text.replace("'", "''") + "'"


def pct(n, total) -> str:
    return f"round(cast({n} as double) * 100 / nullif({total}, 0), 2)"


def share(n, total) -> str:
    return f"(cast({n} as double) * 100 / nullif({total}, 0))"


def bands(value, table) -> str:
    whens = " ".join(f"when {value} {op} {bound} then {lit(text)}"
                     for op, bound, text in table if op)
    return f"case {whens} else {lit(table[-1][2])} end"


def source(style, p="") -> str:
    labels = v.SOURCE_STYLES[style]
    whens = " ".join(f"when {p}{c} is not null then {lit(t)}" for c, t in zip(v.ID_COLS, labels))
    return f"case {whens} else {lit(labels[3])} end"


def missing(style) -> str:
    t = v.MISSING_STYLES[style]
    return (f"case when {ALL_NULL} then {lit(t[0])} when payer_id_fac is null then {lit(t[1])} "
            f"when payer_id_pro is null then {lit(t[2])} "
            f"when payer_id_elig is null then {lit(t[3])} else {lit(t[4])} end")


def nk(c) -> str:
    return f"ifnull(lower({c}), '')"


def rank(c, order) -> str:
    return "case " + " ".join(f"when {c} = {lit(s)} then {i}" for i, s in enumerate(order, 1)) + (
        f" else {len(order) + 1} end")


NAMES = f"{nk('name')} = {nk('oa_name')}"
HIT = "coalesce(payer_id in (payer_id_fac, payer_id_pro, payer_id_elig), false)"
STATUS_V2 = (f"case when {HIT} and {NAMES} then 'EXACT_MATCH' when {HIT} then 'PAYER_ID_ONLY' "
             f"when {NAMES} then 'NAME_ONLY' else 'NO_MATCH' end")
VIA_ID = "case payer_id when payer_id_fac then 'fac' when payer_id_pro then 'pro' " \
         "when payer_id_elig then 'elig' else null end"
VIA_V2 = f"coalesce({VIA_ID}, case when {NAMES} then 'name' end)"
STATUS_PRE = (f"case when {HIT} and {NAMES} then 'EXACT_MATCH' when {HIT} then 'PAYER_ID_ONLY' "
              f"when {NAMES} and payer_id not in (payer_id_fac, payer_id_pro, payer_id_elig) "
              "then 'NAME_ONLY' else 'NO_MATCH' end")
BLANK_HIT = "ifnull(payer_id, '') = ifnull(oa_payer_id, '')"
STATUS_V1 = (f"case when {BLANK_HIT} and {NAMES} then 'EXACT_MATCH' when {BLANK_HIT} then "
             f"'PAYER_ID_ONLY' when {NAMES} then 'NAME_ONLY' else 'NO_MATCH' end")
STATUS_RAW = (f"case when payer_id = oa_payer_id and {NAMES} then 'EXACT_MATCH' "
              "when payer_id = oa_payer_id then 'PAYER_ID_ONLY' "
              f"when payer_id <> oa_payer_id and {NAMES} then 'NAME_ONLY' else 'NO_MATCH' end")
STATUS_PROBE = (f"case when payer_id = oa_payer_id and {NAMES} then 'EXACT_MATCH' "
                "when payer_id = oa_payer_id then 'PAYER_ID_ONLY' "
                "when lower(name) = lower(oa_name) then 'NAME_ONLY' else 'NO_MATCH' end")
STATUS_RANK = rank("match_status", v.MATCHED)
VIA_RANK = rank("matched_via", v.KINDS + ("name",))


def q(c) -> str:
    return f"""'"' || {c} || '"'"""


def details(style, status="match_status", old_id="payer_id", old_name="name", new_id="new_id",
            new_name="oa_name", via="matched_via") -> str:
    if style == "feed":
        texts = (f"'Perfect match. Current payer_id: ' || {old_id} || ', Correct name: ' || {new_name}",
                 f"'Payer ID matches but name differs. Current: ' || {q(old_name)} || ', Correct: ' || {q(new_name)}",
                 f"'Name matches but payer_id differs. Current ID: ' || {old_id} || ', Correct ID: ' || {new_id}",
                 "'No matching record found in payers_oa'")
    elif style == "v0":
        texts = ("'Perfect match. Data synced from insurance_firm_oa.'",
                 f"'Payer ID matches but name differs. Old: ' || {q(old_name)} || ', New: ' || {q(new_name)}",
                 f"'Name matches but payer_id differs. Old: ' || {q(old_id)} || ', New: ' || {q(new_id)}",
                 "'No matching record found in insurance_firm_oa'")
    else:
        by = f" via ' || {via} || '" if style == "v2" else ""
        exact = (f"'Perfect match. Matched via ' || {via} || '. Old values preserved.'"
                 if style == "v2"
                 else "'Perfect match. Old values preserved, new values in *_new columns.'")
        texts = (exact,
                 f"'Payer ID matches{by}. Name differs - old: ' || {q(old_name)} || ', new: ' || {q(new_name)}",
                 f"'Name matches. Payer ID differs - old: ' || {q(old_id)} || ', new: ' || {q(new_id)}",
                 "'Unknown match status'" if style == "v2" else "'Unknown'")
    e, i, n, x = texts
    return (f"case {status} when 'EXACT_MATCH' then {e} when 'PAYER_ID_ONLY' then {i} "
            f"when 'NAME_ONLY' then {n} when 'NO_MATCH' then {x} end")


# ---------------------------------------------------------------- building blocks
_nulls = ", ".join(f"cast(null as varchar) as {c}" for c in v.PAYLOAD_COLS)
_flags = ", ".join(f"case when k % {i} = 0 then 'Yes' else 'No' end as {c}"
                   for i, c in enumerate(v.FLAG_COLS + v.ENROLLMENT_COLS, 2))
_tracking = ("cast(null as varchar) as payer_id_new, cast(null as varchar) as name_new, "
             "cast(null as varchar) as sync_status, cast(null as varchar) as sync_details, "
             "cast(null as timestamp) as last_synced_at, cast(null as varchar) as matched_via")


def _update(base, matches, master="oa", new_id="coalesce(o.payer_id_fac, o.payer_id_pro, o.payer_id_elig)",
            status="m.match_status", text=None, via="m.matched_via") -> str:
    """Take the master's values where a match exists; ``base`` must have tracking columns."""
    def pick(new, c):
        return f"case when m.firm_id is null then f.{c} else {new} end as {c}"
    cols = [pick(f"o.{c}", c) for c in v.PAYLOAD_COLS]
    if new_id:
        cols += [pick(new_id, "payer_id_new"), pick("o.name", "name_new")]
    else:
        cols += ["f.payer_id_new", "f.name_new"]
    cols += [pick(status, "sync_status"), pick(text, "sync_details"), pick(TS, "last_synced_at")]
    cols.append(pick(via, "matched_via") if via else "f.matched_via")
    return (f"select f.firm_id, f.payer_id, f.name, {', '.join(cols)} from {base} f "
            f"left join {matches} m on m.firm_id = f.firm_id left join {master} o on o.firm_id = m.oa_id")


_text_v2 = details("v2", "m.match_status", "f.payer_id", "f.name",
                   "coalesce(o.payer_id_fac, o.payer_id_pro, o.payer_id_elig)", "o.name", "m.matched_via")
_text_v1 = details("v1", "m.match_status", "f.payer_id", "f.name", "o.payer_id", "o.name")


def _insert(fresh, status="'NEW_FROM_OA'", text=None, new_id=NEW_ID, via=None) -> str:
    text = text or f"'New record from OA. Primary payer ID: ' || {source('primary')}"
    via = via or source("via")
    return (f"select row_number() over (order by firm_id) + (select max(firm_id) from firm) as firm_id, "
            f"{new_id} as payer_id, name, {PAYLOAD}, {new_id} as payer_id_new, name as name_new, "
            f"{status} as sync_status, {text} as sync_details, {TS} as last_synced_at, "
            f"{via} as matched_via from {fresh}")


B: dict[str, str] = {
    "firm": f"""select c_custkey as firm_id,
        case when c_custkey % 50 = 12 then 'FAC' || (c_custkey - 2)
             when c_custkey % 10 in (0, 1, 2, 8) then 'FAC' || c_custkey
             when c_custkey % 10 in (3, 4) then 'PRO' || c_custkey
             when c_custkey % 10 = 5 then 'ELG' || c_custkey
             when c_custkey % 10 = 6 then 'OLD' || c_custkey
             when c_custkey % 10 = 9 then 'GARB' || c_custkey end as payer_id,
        case when c_custkey % 97 = 0 then null
             when c_custkey % 10 = 8 then c_name || ' Inc'
             when c_custkey % 10 = 9 then 'TEST ' || c_custkey
             when c_custkey % 23 = 0 then ' ' || c_name || '  x '
             when c_custkey % 2 = 0 then upper(c_name) else c_name end as name,
        {_nulls} from customer""",
    "firm_sub": f"""select * replace (
        case when firm_id % 10 = 9 then 'FAC' || (firm_id - 1) end as payer_id_fac,
        case when firm_id % 10 = 9 then 'PRO' || (firm_id - 2) end as payer_id_pro) from firm""",
    "oa_rows": """select c_custkey as firm_id, c_custkey as k, c_name as name from customer
            where c_custkey % 10 <> 9
        union all select 1000000 + s_suppkey, 1000000 + s_suppkey, s_name from supplier
        union all select 2000000 + c_custkey, c_custkey,
            case when c_custkey % 80 = 1 then c_name else c_name || ' DUP' end
            from customer where c_custkey % 40 = 1""",
    "oa": f"""select firm_id, cast(null as varchar) as payer_id, name,
        case when not (k % 7 = 3 or k % 50 = 6) then 'FAC' || k end as payer_id_fac,
        case when not (k % 11 = 5 or k % 50 = 6) then 'PRO' || k end as payer_id_pro,
        case when not (k % 13 = 4 or k % 50 = 6) then 'ELG' || k end as payer_id_elig,
        {_flags} from oa_rows""",
    "oa1": f"select * replace ({NEW_ID} as payer_id) from oa",
    "pat": """select o_orderkey as patient_insurance_id,
        case when o_orderkey % 203 = 0 then null when o_orderkey % 101 = 0 then cust + 10000000
             else cust end as insurance_firm_id from (select o_orderkey,
             case when o_custkey = 0 then 1 when o_custkey % 3 = 0 then o_custkey - 1 else o_custkey end as cust from orders)""",
    "claims": """select l_orderkey * 10 + l_linenumber as claim_id,
        case when l_orderkey % 211 = 0 then null when o_custkey = 0 then 1 when o_custkey % 4 = 0 then o_custkey - 1
             else o_custkey end as insurance_firm_id
        from lineitem join orders on l_orderkey = o_orderkey""",
    "feed": f"""select payer_id, name, tx as "transaction" from oa1
        cross join (values {", ".join(f"({lit(t)})" for t in TRANSACTIONS)}) t(tx)
        where payer_id is not null and not (firm_id % 9 = 0 and tx like '%Eligibility%')""",
    # joined rows
    "pairs": f"""select f.firm_id, f.payer_id, f.name, o.firm_id as oa_id, o.name as oa_name,
        o.payer_id_fac, o.payer_id_pro, o.payer_id_elig from firm f left join oa o
        on f.payer_id in (o.payer_id_fac, o.payer_id_pro, o.payer_id_elig)
        or lower(f.name) = lower(o.name)""",
    "graded": f"""select *, {STATUS_V2} as match_status, {VIA_V2} as matched_via from pairs""",
    "hits": "select * from graded where oa_id is not null",
    "resolved": f"""select * from hits qualify row_number() over (
        partition by firm_id order by {STATUS_RANK}, {VIA_RANK}, oa_id) = 1""",
    "pairs1": """select f.firm_id, f.payer_id, f.name, o.firm_id as oa_id, o.name as oa_name,
        o.payer_id as oa_payer_id from firm f left join oa1 o
        on f.payer_id = o.payer_id or lower(f.name) = lower(o.name)""",
    "graded1": f"select *, {STATUS_V1} as match_status from pairs1",
    "resolved1": f"""select * from graded1 where oa_id is not null qualify row_number() over (
        partition by firm_id order by {STATUS_RANK}, oa_id) = 1""",
    "pivoted": """select payer_id, name,
        max(case when "transaction" like '%Professional%' then payer_id end) as professional_payer_id,
        max(case when "transaction" like '%Institutional%' or "transaction" like '%Facility%'
            then payer_id end) as facility_payer_id,
        max(case when "transaction" like '%Eligibility%' then payer_id end) as eligibility_payer_id
        from feed group by payer_id, name""",
    "pairs_raw": """select f.firm_id, f.payer_id, f.name, o.payer_id || '|' || o.name as oa_id,
        o.name as oa_name, o.payer_id as oa_payer_id, professional_payer_id, facility_payer_id,
        eligibility_payer_id from firm f left join pivoted o
        on f.payer_id = o.payer_id or lower(f.name) = lower(o.name)""",
    "pairs_probe": """select f.firm_id, f.payer_id, f.name,
        o.payer_id || '|' || o.name || '|' || o."transaction" as oa_id,
        o.name as oa_name, o.payer_id as oa_payer_id from firm f left join feed o
        on f.payer_id = o.payer_id or lower(f.name) = lower(o.name)""",
    # gaps
    "garbage": f"""select firm_id, payer_id, name, count(*) as joined_rows from pairs
        where {ALL_NULL} group by firm_id, payer_id, name""",
    "lost": "select firm_id, payer_id, name from pairs where oa_id is null",
    "fresh": "select * from oa where firm_id not in (select oa_id from hits)",
    "fresh1": """select * from oa1 where firm_id not in
        (select oa_id from pairs1 where oa_id is not null)""",
    "pat_ids": "select distinct insurance_firm_id as firm_id from pat where insurance_firm_id is not null",
    "claim_ids": "select distinct insurance_firm_id as firm_id from claims where insurance_firm_id is not null",
    "pat_n": "select insurance_firm_id as firm_id, count(*) as patients from pat group by 1",
    "claim_n": "select insurance_firm_id as firm_id, count(*) as n from claims group by 1",
    # states
    "tracked": f"select *, {_tracking} from firm",
    "tracked_sub": f"select *, {_tracking} from firm_sub",
    "updated": _update("tracked", "resolved", text=_text_v2),
    "updated_sub": _update("tracked_sub", "resolved", text=_text_v2),
    "updated1": _update("tracked", "resolved1", "oa1", "o.payer_id", text=_text_v1,
                        via="cast(null as varchar)"),
    "kept": """select * from updated where firm_id not in (select firm_id from lost)
        or firm_id in (select firm_id from pat_ids)""",
    "inserted": _insert("fresh"),
    "synced": "select * from kept union all by name select * from inserted",
    "kept_c": "select * from updated where firm_id not in (select firm_id from garbage)",
    "fresh_c": """select * from oa where firm_id not in
        (select oa_id from hits where firm_id in (select firm_id from kept_c))""",
    "shaken": f"select * from kept_c union all by name {_insert('fresh_c')}",
    "annotated": f"""select f.firm_id, f.payer_id, f.name, {", ".join(
        f"case when st <> 'NO_MATCH' then o.{c} else f.{c} end as {c}" for c in v.PAYLOAD_COLS)},
        st as match_status, {details("v0", "st", "f.payer_id", "f.name", "o.payer_id", "o.name")} as match_details,
        o.name as correct_name_from_oa, {TS} as last_synced_at
        from (select g.*, coalesce(r.match_status, case
                when ifnull(g.payer_id, '') = '' and ifnull(g.name, '') = '' then 'EXACT_MATCH'
                when ifnull(g.payer_id, '') = '' then 'PAYER_ID_ONLY'
                when ifnull(g.name, '') = '' then 'NAME_ONLY' else 'NO_MATCH' end) as st, r.oa_id
              from firm_sub g left join resolved1 r on r.firm_id = g.firm_id) f
        left join oa1 o on o.firm_id = f.oa_id""",
    "mapped": f"""select f.firm_id, f.payer_id, f.name, m.professional_payer_id, m.facility_payer_id,
        m.eligibility_payer_id, coalesce(m.match_status, 'NO_MATCH') as match_status,
        {details("feed", "coalesce(m.match_status, 'NO_MATCH')", "f.payer_id", "f.name", "m.oa_payer_id", "m.oa_name")} as match_details,
        m.oa_name as name_from_payers_oa, {TS} as last_synced_at from firm f left join (
            select *, {STATUS_RAW} as match_status from pairs_raw where oa_id is not null
            qualify row_number() over (partition by firm_id order by {STATUS_RANK}, oa_id) = 1
        ) m on m.firm_id = f.firm_id""",
    "mapping": """select g.firm_id as old_firm_id, min(s.firm_id) as new_firm_id, g.payer_id as old_payer_id
        from (select firm_id, payer_id, unnest([payer_id_fac, payer_id_pro, payer_id_elig]) as key
              from firm_sub where firm_id in (select firm_id from lost)) g
        join (select firm_id, unnest([payer_id, payer_id_fac, payer_id_pro, payer_id_elig]) as key
              from resolved where firm_id not in (select firm_id from lost)) s on s.key = g.key
        group by g.firm_id, g.payer_id""",
    "moved": """select patient_insurance_id, coalesce(new_firm_id, insurance_firm_id) as insurance_firm_id
        from pat left join mapping on old_firm_id = insurance_firm_id""",
}


def _active(base, members) -> str:
    """Update the firms a member query lists and mark how they are used."""
    usage = ("case when m.firm_id in (select firm_id from claim_ids) then 'In Claims' "
             "else 'Patient Only' end")
    return _update(base, f"(select * from resolved where firm_id in ({members}))",
                   status="'ACTIVE_' || m.match_status",
                   text=f"'Updated with OA data. Usage: ' || {usage} || '. Matched via: ' || m.matched_via")


_USED = "select firm_id from pat_ids"
_USED_SAFE = "select firm_id from pat_ids union select firm_id from claim_ids"


def _cleaned(members, tag) -> dict[str, str]:
    return {
        f"active_{tag}": _active("tracked", members),
        f"used_{tag}": f"select * from active_{tag} where firm_id in ({members})",
        f"fresh_{tag}": f"""select * from oa where firm_id not in
            (select oa_id from hits where firm_id in (select firm_id from used_{tag}))""",
        f"cleaned_{tag}": f"select * from used_{tag} union all by name " + _insert(
            f"fresh_{tag}", "'RELOADED_FROM_OA'", "'Reloaded from OA after cleanup'"),
    }


B.update(_cleaned(_USED, "ref"))
B.update(_cleaned(_USED_SAFE, "safe"))


def _needs(sql: str) -> list[str]:
    """Blocks a statement mentions, dependencies first."""
    out: list[str] = []

    def visit(text):
        for word in re.findall(r"[a-z_0-9]+", re.sub(r"'[^']*'", "", text)):
            if word in B and word not in out and word not in path:
                path.append(word)
                visit(B[word])
                path.pop()
                out.append(word)

    path: list[str] = []
    visit(sql)
    return out


def build(sql: str) -> str:
    parts = [f"{name} as materialized ({B[name]})" for name in _needs(sql)]
    return ("with " + ",\n".join(parts) + "\n" if parts else "") + sql


# ---------------------------------------------------------------- final selects
TABLE_COLS = f"firm_id, payer_id, name, {PAYLOAD}, payer_id_new, name_new, sync_status, sync_details, last_synced_at, matched_via"
_PAIR = f"firm_id, payer_id as old_payer_id, name as old_name, oa_id, oa_name as new_name, {IDS}"
_PAIR1 = "firm_id, payer_id as old_payer_id, name as old_name, oa_id, oa_name as new_name, oa_payer_id as payer_id"
_N = {t: f"(select count(*) from {t})" for t in ("firm", "oa", "pat", "synced", "updated")}


def _prediction(status, via, pairs, how="left") -> str:
    where = "" if how == "left" else "where oa_id is not null"
    total = _N["firm"] if how == "left" else "sum(count(*)) over ()"
    by = f", {via} as matched_via" if via else ""
    return (f"select match_status{', matched_via' if via else ''}, count(*) as predicted_count, "
            f"count(distinct firm_id) as distinct_firms, {pct('count(*)', total)} as percentage "
            f"from (select firm_id, {status} as match_status{by} from {pairs} {where}) "
            f"group by match_status{', matched_via' if via else ''}")


def _distribution(table, by="sync_status, matched_via", where="", total="sum(count(*)) over ()") -> str:
    return (f"select {by}, count(*) as record_count, {pct('count(*)', total)} as percentage "
            f"from {table} {where} group by {by}")


def _stack(rows) -> str:
    return " union all ".join(rows)


def _columns(df_table, spec_found) -> str:
    rows = []
    for c, t, limit in v.TRACKING_SPEC:
        over = f"count(*) filter (where length({c}) > {limit})" if limit and spec_found else "0"
        nulls = f"count(*) filter (where {c} is null)" if spec_found else "cast(null as bigint)"
        rows.append(f"select {lit(c)} as column_name, '{'found' if spec_found else 'missing'}' as status, "
                    f"cast({lit(t if spec_found else None)} as varchar) as data_type, cast({limit or 'null'} as bigint) as max_length, "
                    f"count(*) as total_rows, {nulls} as null_rows, cast({over} as bigint) as over_length_rows "
                    f"from {df_table}")
    return _stack(rows)


_SYNC_COLUMNS = ("firm_id", "payer_id", "name") + v.PAYLOAD_COLS + v.TRACKING_COLS


def _origin(c) -> str:
    original, added, from_oa, flag, other = v.COLUMN_ORIGINS
    if c in ("payer_id", "name"):
        return original
    if c in v.TRACKING_COLS:
        return added
    if c in v.ID_COLS + v.ENROLLMENT_COLS:
        return from_oa
    return flag if c in v.FLAG_COLS else other


_ORPHAN = "insurance_firm_id is null or insurance_firm_id not in (select firm_id from {})"


def _health(fact, table, where="") -> str:
    bad = f"count(*) filter (where {_ORPHAN.format(table)})"
    return (f"select count(*) as total_records, count(*) - {bad} as valid_records, {bad} as orphaned_records, "
            f"{pct(f'(count(*) - {bad})', 'count(*)')} as integrity_percentage, "
            f"{bands(share(bad, 'count(*)'), v.INTEGRITY_BANDS)} as integrity_status from {fact} {where}")


def _impact(rows, key="firm_id") -> str:
    return (f"select count(*) as garbage_firms_with_patients, "
            f"cast(coalesce(sum(joined_rows * patients), 0) as bigint) as total_patient_records_affected "
            f"from {rows} join pat_n using (firm_id)")


def _preview(labels, pairs, status, cols) -> str:
    whens = " ".join(f"when '{s}' then {lit(t)}" for s, t in zip(v.MATCHED, labels))
    return (f"select firm_id, payer_id as old_payer_id, name as old_name, oa_id, {cols}, oa_name as new_name, "
            f"case {status} {whens} else {lit(labels[3])} end as action from {pairs} "
            "order by firm_id, oa_id nulls first limit 20")


_SEGMENTS = {
    "claims": "(select count(*) from claim_ids)",
    "patient_only": "(select count(*) from pat_ids where firm_id not in (select firm_id from claim_ids))",
    "unused": "(select count(*) from firm where firm_id not in (select firm_id from pat_ids))",
    "total": "(select count(*) from firm)",
}


def _late(where) -> str:
    joined = (f"select s.firm_id, s.payer_id, s.name, s.name_new, o.firm_id as oa_id, o.name as oa_name, "
              "o.payer_id_fac, o.payer_id_pro, o.payer_id_elig "
              f"from (select * from synced {where}) s join oa o "
              "on s.payer_id in (o.payer_id_fac, o.payer_id_pro, o.payer_id_elig) "
              "or lower(s.name) = lower(o.name) or lower(s.name_new) = lower(o.name)")
    late = (f"(select * from (select *, {STATUS_V2} as match_status, {VIA_V2} as matched_via from ({joined})) "
            f"qualify row_number() over (partition by firm_id order by {STATUS_RANK}, {VIA_RANK}, oa_id) = 1)")
    return _update("synced", late, status="'SYNCED_LATE'",
                   text="'Synced in cleanup phase via ' || ifnull(m.matched_via, 'unknown')")


def _late1() -> str:
    joined = ("select s.firm_id, s.payer_id_new as payer_id, s.name_new as name, o.firm_id as oa_id, "
              "o.name as oa_name, o.payer_id as oa_payer_id "
              f"from (select * from updated1 where {ANY_NULL}) s join oa1 o "
              "on s.payer_id_new = o.payer_id or lower(s.name_new) = lower(o.name)")
    late = (f"(select * from (select *, {STATUS_V1} as match_status from ({joined})) "
            f"qualify row_number() over (partition by firm_id order by {STATUS_RANK}, oa_id) = 1)")
    return _update("updated1", late, "oa1", None, "'SYNCED_LATE'", "'Synced in cleanup phase'", None)


_DIFFER = "(payer_id <> payer_id_new or name <> name_new)"
_READY = f"sync_status in {STATUSES} and payer_id_new is not null and name_new is not null"


def _migrate(text, hit=f"{_DIFFER} and {_READY}", stamp=True) -> str:
    hit = f"coalesce({hit}, false)"
    new = {"payer_id": "payer_id_new", "name": "name_new",
           "sync_status": "'MIGRATED_' || sync_status", "sync_details": text}
    if stamp:
        new["last_synced_at"] = TS
    cols = [f"case when {hit} then {new[c]} else {c} end as {c}" if c in new else c
            for c in _SYNC_COLUMNS]
    return f"select {', '.join(cols)} from synced"


def _resolve(changes, hit) -> str:
    cols = ("firm_id", "payer_id", "name") + v.PAYLOAD_COLS + (
        "match_status", "match_details", "correct_name_from_oa", "last_synced_at")
    return "select " + ", ".join(
        f"case when {hit} then {changes[c]} else {c} end as {c}" if c in changes else c
        for c in cols) + " from annotated"


_MISMATCH = ("case when payer_id <> payer_id_new and name <> name_new then {} "
             "when payer_id <> payer_id_new then {} when name <> name_new then {} else {} end").format(
    *map(lit, v.MISMATCH))
_OLD_NEW_COLS = ("firm_id, payer_id as old_payer_id, payer_id_new as new_payer_id, name as old_name, "
                 "name_new as new_name, matched_via, sync_status")
_COMPARE = "case payer_id " + " ".join(
    f"when {c} then {lit(t)}" for c, t in zip(v.ID_COLS + ("payer_id_new",), v.OLD_VS_NEW)) + (
    f" else {lit(v.OLD_VS_NEW[4])} end")
_REASON = (f"case when sync_status in {REVIEW} then {lit(v.REVIEW_REASONS[0])} "
           f"when {ALL_NULL} then {lit(v.REVIEW_REASONS[1])} "
           f"when payer_id_new is null then {lit(v.REVIEW_REASONS[2])} "
           f"when name_new is null then {lit(v.REVIEW_REASONS[3])} else {lit(v.REVIEW_REASONS[4])} end")
_NEEDS_REVIEW = f"(sync_status in {REVIEW} or {ANY_NULL} or payer_id_new is null or name_new is null)"
_SPACES = "(contains(name, '  ') or starts_with(name, ' ') or ends_with(name, ' '))"
_INVALID = "(payer_id is null or name is null or name like '%TEST%' or name like '%DEMO%')"
_LEVEL = ("case when {0} = 1 then '1 patient affected' when {0} between 2 and 10 then {0} || ' patients affected' "
          "else {0} || ' patients affected - HIGH IMPACT' end")
_GRAMS = ("list_distinct(flatten(list_transform(regexp_extract_all({0}, '[\\p{{L}}\\p{{N}}]+'), "
          "lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3)))))")

_WITH_COUNTS = ("select f.*, coalesce(p.patients, 0) as patient_count, coalesce(c.n, 0) as claims_count "
                "from {0} f left join pat_n p on p.firm_id = f.firm_id left join claim_n c on c.firm_id = f.firm_id")

S: dict[str, str] = {
    "load_tables": _stack([f"select '{n}' as table_name, count(*) as row_count from {t}" for n, t in (
        ("insurance_firm", "firm"), ("insurance_firm_oa", "oa"), ("patient_insurance", "pat"),
        ("pms_claims", "claims"), ("payers_oa", "feed"))]),
    "add_tracking_columns": f"select {TABLE_COLS} from tracked",
    "add_tracking_columns__v0": "select *, " + ", ".join(
        f"cast(null as {'timestamp' if t == 'timestamp' else 'varchar'}) as {c}"
        for c, t, _ in v.TRACKING_SPEC_V0) + " from firm",
    "verify_columns": _columns("synced", True),
    "verify_columns__before": _columns("firm", False),
    "verify_columns__summary": f"""select cast(6 as bigint) as columns_found,
        {lit(v.COLUMNS_FOUND[0].format(n=6))} as status, {lit(v.SETUP_VERDICT[0])} as final_status,
        count(*) as total_rows from synced""",
    "classify_columns": _stack([
        f"select {lit(c)} as column_name, cast({i} as bigint) as ordinal_position, {lit(_origin(c))} as column_type, "
        f"count({c}) as populated_rows from synced" for i, c in enumerate(_SYNC_COLUMNS, 1)]),
    "rollback__drop": f"select firm_id, payer_id, name, {PAYLOAD} from updated",
    "rollback__clear": f"select firm_id, payer_id, name, {PAYLOAD}, {_tracking} from updated",
    "canonical_payer_id": f"select firm_id, {NEW_ID} as canonical_payer_id from oa",
    "payer_source": "select firm_id, " + ", ".join(
        f"{source(s)} as source_{s}" for s in v.SOURCE_STYLES) + " from oa",
    "name_key": f"select firm_id, {nk('name')} as name_key from firm",
    "whitespace_issues": f"""select firm_id, payer_id, {q('name')} as name_with_quotes,
        length(name) - length(replace(name, ' ', '')) as space_count from firm where {_SPACES}""",
    "whitespace_issues__count": f"select count(*) filter (where {_SPACES}) as names_with_whitespace_issues from firm",
    "trim_names": "select firm_id, trim(name) as name from firm",
    "sync_details": "select firm_id, sync_details from updated",
    "sync_details__v0": f"select firm_id, oa_id, {details('v0', new_id='oa_payer_id')} as sync_details from graded1",
    "sync_details__v1": f"select firm_id, oa_id, {details('v1', new_id='oa_payer_id')} as sync_details from graded1",
    "sync_details__feed": "select firm_id, match_details from mapped",
    "mismatch_type": f"select firm_id, {_MISMATCH} as mismatch_type from synced",
    "name_length_compare": f"""select firm_id, payer_id, name as current_name_in_firm,
        correct_name_from_oa as correct_name_in_oa, match_details,
        case when length(name) < length(correct_name_from_oa) then {lit(v.NAME_LENGTH[0])}
             when length(name) > length(correct_name_from_oa) then {lit(v.NAME_LENGTH[1])}
             else {lit(v.NAME_LENGTH[2])} end as comparison
        from annotated where match_status = 'PAYER_ID_ONLY'""",
    "missing_id_label": "select firm_id, " + ", ".join(f"{missing(s)} as {s}" for s in v.MISSING_STYLES) + """,
        cast((payer_id_fac is not null)::int + (payer_id_pro is not null)::int
        + (payer_id_elig is not null)::int as bigint) as completeness_count from synced""",
    "old_vs_new": f"select firm_id, {_COMPARE} as old_vs_new_comparison from synced",
    "review_reason": f"select firm_id, {_REASON} as review_reason from synced",
    "strip_status_prefix": """select firm_id, sync_status,
        case when starts_with(sync_status, 'ACTIVE_') then substr(sync_status, 8) else sync_status end as status
        from cleaned_ref""",
    "invalid_payer_predicate": f"select firm_id, payer_id, name from firm where {_INVALID}",
    "recently_synced": f"""select count(*) as records_updated from synced where sync_status is not null
        and last_synced_at >= {TS} + interval 30 second - interval 1 minute""",
    "impact_level": f"""select firm_id, patients as patient_count, {_LEVEL.format('patients')} as impact_level
        from pat_n where firm_id in (select firm_id from firm)""",
    "oa_match_status": f"""select firm_id, payer_id, name, sync_status, matched_via,
        case when sync_status in {STATUSES} then {lit(v.OA_MATCH[0])} else {lit(v.OA_MATCH[1])} end as oa_match_status
        from updated where firm_id not in (select firm_id from pat_ids)""",
    "threshold_label": _stack([
        f"select {lit(t)} as category, {pct(f'count({c})', 'count(*)')} as completeness_percentage, "
        f"{bands(share(f'count({c})', 'count(*)'), v.QUALITY_BANDS)} as quality_rating from synced"
        for c, t in zip(v.ID_COLS, v.PAYER_TYPE_NAMES)]),
    # joins
    "match_pairs": f"select {_PAIR} from pairs",
    "match_pairs__inner": f"select {_PAIR} from pairs where oa_id is not null",
    "match_pairs__single": f"select {_PAIR1} from pairs1",
    "classify_matches": f"select {_PAIR}, match_status, matched_via from graded",
    "classify_matches__preflight": f"select {_PAIR}, {STATUS_PRE} as match_status, {VIA_ID} as matched_via from pairs",
    "classify_matches__v1": f"select {_PAIR1}, match_status from graded1",
    "classify_matches__raw": f"select {_PAIR1}, {STATUS_RAW} as match_status from pairs_raw",
    "classify_matches__probe": f"select {_PAIR1}, {STATUS_PROBE} as match_status from pairs_probe",
    "resolve_matches": f"""select firm_id, payer_id as old_payer_id, name as old_name, oa_id, match_status,
        matched_via, {NEW_ID} as new_payer_id, oa_name as new_name from resolved""",
    "garbage_firms": "select firm_id, payer_id, name, joined_rows from garbage",
    "garbage_firms__strict": "select firm_id, payer_id, name, cast(1 as bigint) as joined_rows from lost",
    "garbage_firms__v1": """select firm_id, payer_id, name, count(*) as joined_rows from pairs1
        where oa_payer_id is null group by all""",
    "garbage_firms__count": f"""select count(*) as garbage_count, count(distinct firm_id) as garbage_firms
        from pairs where {ALL_NULL}""",
    "remaining_garbage": f"""select count(*) as remaining_garbage_count,
        {bands('count(*)', v.REMAINING_BANDS)} as status from pairs
        where {ALL_NULL} and firm_id in (select firm_id from kept)""",
    "new_from_oa": f"""select firm_id as oa_id, payer_id, name, {IDS}, {NEW_ID} as will_be_payer_id,
        {source('short')} as primary_payer_source from fresh""",
    "new_from_oa__v1": f"""select firm_id as oa_id, payer_id, name, {IDS}, payer_id as will_be_payer_id,
        {source('short')} as primary_payer_source from fresh1""",
    "new_from_oa__count": f"""select count(*) as predicted_insert_count,
        {pct('count(*)', _N['oa'])} as percentage_of_oa from fresh""",
    "new_from_oa_tuple_in": f"""select name, {IDS}, {NEW_ID} as will_be_payer_id,
        {source('short')} as primary_payer_source from oa
        where ({IDS}, name) in (select ({IDS}, name) from fresh)
        and payer_id_fac is not null and payer_id_pro is not null and payer_id_elig is not null and name is not null""",
    "new_from_oa_tuple_in__v1": f"""select payer_id, name, {IDS} from oa1
        where (payer_id, name) in (select (payer_id, name) from fresh1)
        and payer_id is not null and name is not null""",
    "orphans": f"""select patient_insurance_id, insurance_firm_id as missing_firm_id from pat
        where {_ORPHAN.format('firm')}""",
    "orphans__count": f"""select count(*) as orphaned_count, {bands('count(*)', v.ORPHAN_BANDS)} as status
        from pat where {_ORPHAN.format('synced')}""",
    "orphans__claims": f"""select claim_id, insurance_firm_id as missing_firm_id from claims
        where insurance_firm_id not in (select firm_id from cleaned_ref)""",
    "orphans__claims_count": f"""select count(*) as orphaned_count, {bands('count(*)', v.ORPHAN_BANDS)} as status
        from claims where insurance_firm_id not in (select firm_id from cleaned_ref)""",
    "unused_firms": """select firm_id, payer_id, name, sync_status from synced
        where firm_id not in (select firm_id from pat_ids)""",
    "unused_firms__count": f"""select count(*) as firm_count,
        {bands(share('count(*)', _N['synced']), v.UNUSED_BANDS)} as status,
        {_N['synced']} as total_firms, {pct('count(*)', _N['synced'])} as percentage
        from synced where firm_id not in (select firm_id from pat_ids)""",
    "firms_in_claims": """select firm_id, payer_id, name, sync_status, sync_details, matched_via from updated
        where firm_id in (select firm_id from claim_ids)""",
    "firms_in_patients": f"""select firm_id, payer_id, name, sync_status, matched_via, patient_count, claims_count
        from ({_WITH_COUNTS.format('updated')}) where patient_count > 0""",
    "firms_patient_only": f"""select firm_id, payer_id, name, sync_status, sync_details, matched_via, patient_count,
        claims_count from ({_WITH_COUNTS.format('updated')}) where patient_count > 0 and claims_count = 0""",
    "patient_impact": _impact("garbage"),
    "patient_impact__strict": _impact("(select *, 1 as joined_rows from lost)"),
    "patient_impact__v1": _impact("(select firm_id, count(*) as joined_rows from pairs1 where oa_payer_id is null group by 1)"),
    "patient_impact__check": f"""select garbage_firms_with_patients as firms_with_patients,
        total_patient_records_affected as total_patient_records,
        {bands('total_patient_records_affected', v.IMPACT_BANDS)} as recommendation from ({_impact('garbage')})""",
    "patient_impact__detail": f"""select firm_id, payer_id as firm_payer_id, name as firm_name,
        joined_rows * patients as patient_count, {_LEVEL.format('(joined_rows * patients)')} as impact_level
        from garbage join pat_n using (firm_id) order by patient_count desc, firm_id limit 20""",
    "patient_impact__sample": f"""select patient_insurance_id, firm_id, payer_id as firm_payer_id, name as firm_name
        from pat join pairs on firm_id = insurance_firm_id where {ALL_NULL}
        order by patient_insurance_id limit 20""",
    "null_payer_impact": f"""select count(distinct insurance_firm_id) as unique_firms_referenced,
        count(*) as total_patient_insurance_records,
        count(*) filter (where f.firm_id is not null and f.payer_id is null) as affected_patients,
        count(*) filter (where f.firm_id is not null and (f.payer_id is null or f.name is null))
            as affected_patients_id_or_name,
        {_N['firm']} as total_firms, (select count(*) from firm where payer_id is null) as firms_with_null_payer_id
        from pat left join firm f on f.firm_id = insurance_firm_id""",
    "reassignable_firms": f"""select count(distinct firm_id) as firms_can_be_reassigned from hits
        where not ({ALL_NULL}) and firm_id in (select firm_id from pat_ids)""",
    "fuzzy_name_matches": f"""with a as (select firm_id, name, payer_id, {_GRAMS.format('lower(name)')} as g from firm
            where name is not null),
        b as (select firm_id, name, payer_id, {_GRAMS.format('lower(name)')} as g from oa1
            where name is not null and payer_id is not null),
        ag as (select firm_id, unnest(g) as gram from a), bg as (select firm_id, unnest(g) as gram from b),
        common as (select ag.firm_id, bg.firm_id as oa_id, count(*) as n from ag join bg using (gram) group by 1, 2),
        scored as (select c.firm_id, c.oa_id, a.name as insurance_firm_name, b.name as payers_oa_name,
            a.payer_id as insurance_firm_payer_id, b.payer_id as payers_oa_payer_id,
            cast(n as double) / (len(a.g) + len(b.g) - n) as name_similarity
            from common c join a on a.firm_id = c.firm_id join b on b.firm_id = c.oa_id)
        select * from scored where name_similarity > 0.6 and name_similarity < 1.0
        order by name_similarity desc, firm_id, oa_id limit 20""",
    "correct_id_by_name": """select a.firm_id, a.name as payer_name, a.payer_id as current_payer_id_in_firm,
        a.correct_name_from_oa, o.payer_id as correct_payer_id_in_oa, a.match_details from annotated a
        left join (select lower(name) as l, min(firm_id) as firm_id from oa1 group by 1) x on x.l = lower(a.name)
        left join oa1 o on o.firm_id = x.firm_id where a.match_status = 'NAME_ONLY'""",
    "sub_payer_probe": f"""select firm_id, payer_id, name, {IDS}, """ + ", ".join(
        f"(select count(*) from oa1 o where o.payer_id = annotated.payer_id_{k}) as {k}_id_in_oa" for k in v.KINDS)
        + " from annotated where match_status = 'NO_MATCH'",
    "sub_payer_match": """select a.firm_id, min(o.payer_id) as matched_payer_id from annotated a join oa1 o
        on o.payer_id in (a.payer_id_fac, a.payer_id_pro, a.payer_id_elig)
        where match_status = 'NO_MATCH' group by a.firm_id""",
    "match_preview": _preview(v.PREVIEW_ACTIONS, "graded", "match_status", IDS),
    "match_preview__v0": _preview(v.PREVIEW_TYPES, "graded1", "match_status", "oa_payer_id as new_payer_id"),
    "match_preview__v1": _preview(v.PREVIEW_ACTIONS, "graded1", "match_status", "oa_payer_id as new_payer_id"),
    "match_preview__probe": f"""select firm_id, payer_id as current_payer_id, name as current_name,
        oa_payer_id as payers_oa_id, oa_name as payers_oa_name, {STATUS_PROBE} as expected_match_status
        from pairs_probe order by firm_id, oa_id nulls first limit 20""",
    "match_preview__exact": f"""select firm_id, payer_id as old_payer_id, name as old_name, oa_id,
        {NEW_ID} as new_payer_id, oa_name as new_name, matched_via, {IDS}
        from hits where match_status = 'EXACT_MATCH' order by firm_id, oa_id limit 10""",
    "match_preview__payer_id_only": f"""select firm_id, payer_id as old_payer_id, name as old_name, oa_id,
        {NEW_ID} as new_payer_id, oa_name as new_name, 'Old: ' || {q('name')} || ' → New: ' || {q('oa_name')} as issue,
        matched_via from hits where match_status = 'PAYER_ID_ONLY' order by firm_id, oa_id limit 10""",
    "match_preview__name_only": f"""select firm_id, payer_id as old_payer_id, name as old_name, oa_id,
        {NEW_ID} as new_payer_id, oa_name as new_name,
        'Old ID: ' || {q('payer_id')} || ' → New ID: ' || {q(NEW_ID)} as issue
        from hits where lower(name) = lower(oa_name) and payer_id <> payer_id_fac and payer_id <> payer_id_pro
        and payer_id <> payer_id_elig order by firm_id, oa_id limit 10""",
    "match_preview__no_match": f"""select firm_id, payer_id, name, {lit(v.NO_MATCH_REASON)} as reason
        from pairs where {ALL_NULL} order by firm_id limit 10""",
    "match_preview__problems": f"""select firm_id, payer_id as current_payer_id, name as current_name, oa_id,
        oa_payer_id as correct_payer_id, oa_name as correct_name, match_status,
        'Current: ' || {q('name')} || ' -> Correct: ' || {q('oa_name')} as issue from graded1
        where match_status in ('PAYER_ID_ONLY','NAME_ONLY','NO_MATCH')
        order by firm_id, oa_id nulls first limit 20""",
    # aggregations
    "profile_firm__null_payers": "select firm_id, payer_id, name from firm where payer_id is null",
    "profile_firm": f"""select *, 'insurance_firm: ' || total_records || ' records, ' || complete_records
        || ' complete (' || printf('%.2f', completeness_percentage) || '%)' as firm_quality from (
        select count(*) as total_records, count(*) - count(payer_id) as null_payer_id,
        count(*) - count(name) as null_name,
        count(*) filter (where payer_id is not null and name is not null) as complete_records,
        {pct('count(*) filter (where payer_id is not null and name is not null)', 'count(*)')} as completeness_percentage
        from firm)""",
    "profile_oa": f"""select *, 'insurance_firm_oa: ' || total_records || ' records, ' || has_any_payer_id
        || ' have at least one payer ID (' || printf('%.2f', has_any_payer_id_percentage) || '%)' as oa_quality from (
        select count(*) as total_records, {", ".join(f"count(*) - count({c}) as null_{c}" for c in ("payer_id", "name") + v.ID_COLS)},
        count(payer_id) as has_payer_id, count(payer_id_fac) as has_fac, count(payer_id_pro) as has_pro,
        count(payer_id_elig) as has_elig, count({NEW_ID}) as has_any_payer_id,
        {pct(f'count({NEW_ID})', 'count(*)')} as has_any_payer_id_percentage from oa)""",
    "null_check": f"""select count(*) - count(payer_id_fac) as null_fac, count(*) - count(payer_id_pro) as null_pro,
        count(*) - count(payer_id_elig) as null_elig, count(*) - count(payer_id_new) as null_payer_id_new,
        count(*) - count(name_new) as null_name_new, count({NEW_ID}) as rows_with_any_id,
        count(*) as total_records from synced""",
    "match_prediction": _prediction(STATUS_V2, VIA_V2, "pairs"),
    "match_prediction__preflight": _prediction(STATUS_PRE, VIA_ID, "pairs"),
    "match_prediction__v1": _prediction(STATUS_V1, None, "pairs1"),
    "status_distribution": _distribution("synced"),
    "status_distribution__synced": _distribution("synced", where="where sync_status is not null"),
    "status_distribution__share_of_all": _distribution(
        "synced", where="where sync_status is not null", total=_N["synced"]),
    "status_distribution__by_status": _distribution("synced", "sync_status"),
    "status_distribution__analysis": _prediction(STATUS_V2, VIA_V2, "pairs", "inner"),
    "status_distribution__analysis_v1": _prediction(STATUS_V1, None, "pairs1", "inner"),
    "status_distribution__feed": _distribution("mapped", "match_status"),
    "status_distribution__v0": _distribution("annotated", "match_status"),
    "aggregated_summary": "select " + ", ".join(
        f"count(*) filter (where {c}) as {n}_count, {pct(f'count(*) filter (where {c})', 'count(*)')} as {n}_percentage"
        for n, c in (("exact", "sync_status = 'EXACT_MATCH'"), ("needs_review", f"sync_status in {REVIEW}"),
                     ("new", "sync_status = 'NEW_FROM_OA'")))
        + ", count(*) as total_records from synced where sync_status is not null",
    "remaining_issues": """select count(*) filter (where s in ('PAYER_ID_ONLY','NAME_ONLY','NO_MATCH')) as needs_review,
        count(*) filter (where s = 'EXACT_MATCH') as exact_match,
        count(*) filter (where s like 'CORRECTED%') as corrected, count(*) as total
        from (select case when match_status = 'PAYER_ID_ONLY' then 'CORRECTED_PAYER_ID_ONLY' else match_status end as s
              from annotated)""",
    "matched_via_breakdown": f"""select matched_via, count(*) as record_count,
        {pct('count(*)', 'sum(count(*)) over ()')} as percentage, case {" ".join(
            f"when matched_via = {lit(k)} then {lit(t)}" for k, t in v.VIA_DESCRIPTIONS.items())}
        else 'Unknown' end as description from synced where sync_status is not null group by matched_via""",
    "payer_source_breakdown": f"""select {source('from')} as payer_id_source, count(*) as record_count,
        {pct('count(*)', _N['oa'])} as percentage from oa group by 1""",
    "payer_source_breakdown__firm": f"""select {source('from_v2')} as payer_id_source, count(*) as record_count,
        {pct('count(*)', _N['synced'])} as percentage from synced where sync_status is not null group by 1""",
    "feed_cardinality": """select distinct payer_id, name, row_count, "transaction" as transaction_type
        from (select *, count(*) over (partition by payer_id, name) as row_count from feed)
        where row_count <> 3""",
    "pivot_feed": "select * from pivoted",
    "completeness": f"""select count(payer_id_new) as has_payer_id_new, count(name_new) as has_name_new,
        {", ".join(f"count(payer_id_{k}) as has_{k}, {pct(f'count(payer_id_{k})', 'count(*)')} as {k}_percentage" for k in v.KINDS)},
        count(*) as total_records from synced""",
    "completeness_by_type": _stack([
        f"select {lit(t)} as category, count(*) as total_records, count({c}) as populated, "
        f"count(*) - count({c}) as missing, {pct(f'count({c})', 'count(*)')} as completeness_percentage from synced"
        for c, t in zip(v.ID_COLS, v.PAYER_TYPE_NAMES)]),
    "all_three_ids": f"""select count(*) as records_with_all_three, {pct('count(*)', _N['synced'])} as percentage,
        {bands(share('count(*)', _N['synced']), v.ALL_THREE_BANDS)} as status from synced where not {ANY_NULL}""",
    "incomplete": f"""select firm_id, payer_id, name, {IDS}, sync_status, {missing('missing_type')} as missing_type
        from synced where {ANY_NULL}""",
    "incomplete__count": f"""select count(*) as incomplete_count, {bands('count(*)', v.INCOMPLETE_BANDS)} as status
        from synced where {ANY_NULL}""",
    "incomplete__issues": f"""select firm_id, payer_id, name, {IDS}, sync_status, matched_via,
        {missing('issue')} as issue from synced where {ANY_NULL}""",
    "null_columns": _stack([
        f"select '{c}' as column_name, count(*) - count({c}) as null_count, "
        f"{pct(f'(count(*) - count({c}))', 'count(*)')} as null_percentage from synced"
        for c in ("payer_id_new", "name_new", "matched_via", "sync_status")]),
    "quality_score": f"""select {pct('filled', 'cells')} as overall_quality_percentage,
        {bands(share('filled', 'cells'), v.QUALITY_BANDS)} as quality_rating
        from (select count(payer_id_fac) + count(payer_id_pro) + count(payer_id_elig) as filled, 3 * count(*) as cells
              from synced)""",
    "fk_health": _health("pat", "synced"),
    "fk_health__claims": _health("claims", "cleaned_ref", "where insurance_firm_id is not null"),
    "patients_by_status": f"""select sync_status, count(*) as patient_count, {pct('count(*)', _N['pat'])} as percentage
        from pat join synced on firm_id = insurance_firm_id group by sync_status""",
    "top_firms": """select firm_id, payer_id, name, sync_status, patients as patient_count
        from synced join pat_n using (firm_id) order by patient_count desc, firm_id limit 20""",
    "reference_coverage": f"""select r as unique_firms_referenced, t as total_firms_in_table,
        case when r = t then {lit(v.ALL_REFERENCED)}
             else {lit(v.SOME_UNREFERENCED[0])} || (t - r) || {lit(v.SOME_UNREFERENCED[1])} end as status
        from (select count(distinct insurance_firm_id) as r, {_N['synced']} as t
              from pat join synced on firm_id = insurance_firm_id)""",
    "needs_attention": f"""select count(*) as needing_attention from synced
        where sync_status in ('PAYER_ID_ONLY','NAME_ONLY','NO_MATCH') or {ANY_NULL}""",
    "unsynced": "select firm_id, payer_id, name from synced where sync_status is null",
    "unsynced__count": f"""select count(*) as unsynced_count, {bands('count(*)', v.UNSYNCED_BANDS)} as status
        from synced where sync_status is null""",
    "claims_usage": """select count(distinct insurance_firm_id) as unique_firms_in_claims,
        count(insurance_firm_id) as total_claims_with_firm, count(*) as total_claims from claims""",
    "usage_overlap": """select p as firms_in_patient_insurance_only, c as firms_in_claims, p - c as firms_without_claims
        from (select count(*) as p, count(c.firm_id) as c from pat_ids left join claim_ids c using (firm_id))""",
    "usage_match_status": _distribution(
        "updated", where="where firm_id in (select firm_id from claim_ids)", total="(select count(*) from claim_ids)"),
    "usage_match_status__patient_only": _distribution(
        "updated", where="where firm_id in (select firm_id from pat_ids) and firm_id not in (select firm_id from claim_ids)"),
    "claims_no_match": f"""select firm_id, payer_id, name, match_status as sync_status, claims_count, patient_count
        from ({_WITH_COUNTS.format('annotated')}) where match_status = 'NO_MATCH' and claims_count > 0""",
    "claims_no_match__count": """select count(*) as record_count from annotated
        where match_status = 'NO_MATCH' and firm_id in (select firm_id from claim_ids)""",
    "update_preview": """select case when firm_id in (select firm_id from claim_ids) then 'In Claims'
        else 'Patient Only' end as firm_usage, match_status, matched_via,
        cast(sum(r) as bigint) as record_count, cast(sum(j) as bigint) as joined_rows from (
            select firm_id, match_status, matched_via, 1 as r, 0 as j from resolved
            union all select firm_id, match_status, matched_via, 0, 1 from (
                select distinct h.firm_id, h.match_status, h.matched_via, o.name, o.payer_id, """ + ", ".join(
        f"o.{c}" for c in v.PAYLOAD_COLS) + """ from hits h join oa o on o.firm_id = h.oa_id))
        where firm_id in (select firm_id from pat_ids) group by all""",
    "active_status": """select case when starts_with(sync_status, 'ACTIVE_') then substr(sync_status, 8)
        else sync_status end as status, matched_via, count(*) as record_count from cleaned_ref
        where firm_id in (select firm_id from pat_ids) group by all""",
    "active_status__via": """select matched_via, count(*) as record_count from cleaned_ref
        where starts_with(sync_status, 'ACTIVE_') group by all""",
    "reassignment_preview": """select old_firm_id, new_firm_id, old_payer_id, patients as patient_count
        from mapping join pat_n on firm_id = old_firm_id""",
    "deletion_decision": f"""select o as total_patient_records_orphaned, u as unique_firms_orphaned,
        r as firms_can_be_reassigned, {pct('r', 'u')} as reassignable_percentage,
        case when o = 0 then {lit(v.STRATEGY[0])} when o < 10 then {lit(v.STRATEGY[1])}
             when u = r then {lit(v.STRATEGY[2])} else {lit(v.STRATEGY[3])} end as recommended_strategy
        from (select count(*) filter (where {ALL_NULL}) as o,
              count(distinct case when {ALL_NULL} then firm_id end) as u,
              count(distinct case when oa_id is not null then firm_id end) as r
              from pat join pairs on firm_id = insurance_firm_id)""",
    "prediction_summary": f"""select *, current_firm_count - predicted_deletions + predicted_insertions as expected_final_count
        from (select {_N['firm']} as current_firm_count, {_N['oa']} as oa_count,
        (select count(*) from pairs where {ALL_NULL}) as predicted_deletions,
        (select count(*) from fresh) as predicted_insertions)""",
    "success_assessment": f"""select {bands(share('e', 't'), v.EXACT_BANDS)} as exact_match_quality,
        {bands(share('r', 't'), v.REVIEW_BANDS)} as review_workload,
        {bands('abs(t - o)', v.ROW_DIFF_BANDS)} as data_completeness
        from (select count(*) as t, count(*) filter (where sync_status = 'EXACT_MATCH') as e,
              count(*) filter (where sync_status in {REVIEW}) as r, {_N['oa']} as o from synced)""",
    "integrity_summary": f"""select case when l = 0 then {lit(v.NO_ORPHANS)}
        else {lit(v.SOME_ORPHANS[0])} || l || {lit(v.SOME_ORPHANS[1])} end as orphan_status,
        {bands(share('e', 't'), v.FIRM_QUALITY_BANDS)} as match_quality
        from (select count(*) as t, count(*) filter (where sync_status = 'EXACT_MATCH') as e,
              (select count(*) from pat where {_ORPHAN.format('synced')}) as l from synced)""",
    "final_summary": f"""select count(*) as final_firm_count,
        count(*) filter (where sync_status = 'EXACT_MATCH') as exact_matches,
        count(*) filter (where sync_status in {REVIEW}) as needs_review,
        (select count(*) from pat where {_ORPHAN.format('synced')}) as orphaned_patients from synced""",
    "final_summary__cleanup": f"""select *, case when orphaned_patients = 0 and orphaned_claims = 0
        then {lit(v.CLEANUP_VERDICT[0])} else {lit(v.CLEANUP_VERDICT[1])} end as status from (
        select count(*) filter (where starts_with(sync_status, 'ACTIVE_')) as active_firms_updated,
        count(*) filter (where sync_status = 'RELOADED_FROM_OA') as firms_reloaded,
        (select count(*) from pat where {_ORPHAN.format('cleaned_ref')}) as orphaned_patients,
        (select count(*) from claims where insurance_firm_id not in (select firm_id from cleaned_ref)) as orphaned_claims
        from cleaned_ref)""",
    # windows, orders, unions
    "usage_match_quality": f"""select firm_category, sync_status, count(*) as record_count,
        {pct('count(*)', 'sum(count(*)) over (partition by firm_category)')} as percentage from (
        select {lit(v.QUALITY_SEGMENTS[0])} as firm_category, sync_status from updated where firm_id in (select firm_id from claim_ids)
        union all select {lit(v.QUALITY_SEGMENTS[1])}, sync_status from updated
            where firm_id in (select firm_id from pat_ids) and firm_id not in (select firm_id from claim_ids)
        union all select {lit(v.QUALITY_SEGMENTS[2])}, sync_status from updated where firm_id not in (select firm_id from pat_ids))
        group by firm_category, sync_status""",
    "rank_order": f"""select firm_id, cast(coalesce(list_position(
        ['EXACT_MATCH','PAYER_ID_ONLY','NAME_ONLY','NEW_FROM_OA'], sync_status), 5) as bigint) as status_rank from synced""",
    "sample": """select firm_id, payer_id, name, payer_id_new, name_new, matched_via from synced
        where sync_status = 'EXACT_MATCH' order by firm_id limit 5""",
    "sample__new": """select firm_id, payer_id, name, matched_via, sync_status, sync_details from synced
        where sync_status = 'NEW_FROM_OA' order by firm_id desc limit 10""",
    "sample__latest": """select firm_id, payer_id, name, payer_id_new, name_new, matched_via, sync_status, sync_details
        from synced where sync_status is not null order by last_synced_at desc, firm_id limit 20""",
    "status_categories": _stack([
        f"select {lit(t)} as category, count(*) filter (where {c}) as record_count, "
        f"{pct(f'count(*) filter (where {c})', 'count(*)')} as percentage from synced"
        for c, t in [(f"sync_status = '{s}'", t) for s, t in v.STATUS_CATEGORIES if s]
        + [("sync_status is null or sync_status not in ('EXACT_MATCH','PAYER_ID_ONLY','NAME_ONLY','NEW_FROM_OA')",
            v.STATUS_CATEGORIES[-1][1])]]),
    "usage_venn": _stack([f"select {lit(t)} as category, {_SEGMENTS[s]} as firm_count"
                          for t, s in zip(v.VENN_CATEGORIES, _SEGMENTS)]),
    "execution_plan": _stack([f"select {lit(t)} as step, {_SEGMENTS[s]} as firms_count, {lit(a)} as action, {lit(p)} as priority"
                              for (t, a, p), s in zip(v.PLAN_STEPS, _SEGMENTS)]),
    "execution_plan__safety": _stack([f"select {lit(t)} as category, {_SEGMENTS[s]} as firm_count, {lit(a)} as action"
                                      for (t, a), s in zip(v.SAFETY_STEPS, _SEGMENTS)]),
    # mutations
    "update_matched": f"select {TABLE_COLS} from updated",
    "update_matched__v1": f"select {TABLE_COLS} from updated1",
    "update_matched__v0": "select * from annotated",
    "update_matched__feed": "select * from mapped",
    "delete_garbage": f"select {TABLE_COLS} from kept",
    "delete_garbage__reference": f"""select {TABLE_COLS} from updated where firm_id not in (select firm_id from garbage)
        or firm_id in (select firm_id from pat_ids)""",
    "delete_garbage__b": f"""select {TABLE_COLS} from updated_sub where firm_id not in (select firm_id from lost)
        or firm_id in (select insurance_firm_id from moved where insurance_firm_id is not null)""",
    "delete_garbage__b_patients": "select * from moved",
    "delete_garbage__c": f"select {TABLE_COLS} from updated where firm_id not in (select firm_id from lost)",
    "reassign_patients": "select * from moved",
    "insert_new": "select * from tracked union all by name select * from inserted",
    "insert_new__v1": "select * from tracked union all by name " + _insert(
        "fresh1", text="'New record inserted from insurance_firm_oa'", new_id="payer_id",
        via="cast(null as varchar)"),
    "insert_new__reload": "select * from tracked union all by name " + _insert(
        "fresh", "'RELOADED_FROM_OA'", "'Reloaded from OA after cleanup'"),
    "update_active": "select * from active_ref",
    "update_active__safe": "select * from active_safe",
    "delete_unused": f"select * from firm where firm_id in ({_USED})",
    "delete_unused__safe": f"select * from firm where firm_id in ({_USED_SAFE})",
    "delete_unused__count": f"select count(*) as firms_to_delete from firm where firm_id not in ({_USED})",
    "late_sync": _late(f"where {ANY_NULL}"),
    "late_sync__all": _late(""),
    "late_sync__v1": _late1(),
    "fix_orphans": """select patient_insurance_id, coalesce(t.new_firm_id, insurance_firm_id) as insurance_firm_id
        from pat left join (select s.firm_id as old_firm_id, min(f.firm_id) as new_firm_id from firm s join shaken f
            on s.payer_id in (f.payer_id_new, f.payer_id_fac, f.payer_id_pro, f.payer_id_elig)
            or lower(s.name) = lower(f.name_new)
            where s.firm_id in (select firm_id from pat_ids) and s.firm_id not in (select firm_id from shaken)
            group by s.firm_id) t on t.old_firm_id = insurance_firm_id""",
    "fix_orphans__null": """select patient_insurance_id, case when insurance_firm_id in (select firm_id from shaken)
        then insurance_firm_id end as insurance_firm_id from pat""",
    "fix_orphans__delete": "select * from pat where insurance_firm_id in (select firm_id from shaken)",
    "migrate": _migrate(f"'Migrated from ' || {q('payer_id')} || ' / ' || {q('name')} || ' to ' || {q('payer_id_new')} || ' / ' || {q('name_new')}"),
    "migrate__via": _migrate(f"'Migrated from ' || {q('payer_id')} || ' / ' || {q('name')} || ' to ' || {q('payer_id_new')} || ' / ' || {q('name_new')} || ' via ' || matched_via"),
    "migrate__v1": _migrate(f"'Migrated. Old: ' || {q('payer_id')} || ' / ' || {q('name')} || ' -> New: ' || {q('payer_id_new')} || ' / ' || {q('name_new')}"),
    "migrate__v1_review": _migrate(
        f"'Migrated from old to new values. Old: ' || {q('payer_id')} || ' -> ' || {q('payer_id_new')}",
        f"sync_status in {REVIEW} and payer_id_new is not null and name_new is not null", False),
    "migrate__preview": f"""select firm_id, payer_id as current_payer_id, payer_id_new as new_payer_id,
        name as current_name, name_new as new_name, matched_via, sync_status,
        'Will migrate to new values' as action from synced where {_DIFFER} and {_READY}""",
    "correct_payer_id_only": _resolve({
        "name": "correct_name_from_oa", "match_status": "'CORRECTED_PAYER_ID_ONLY'",
        "match_details": f"'Updated name from ' || {q('name')} || ' to ' || {q('correct_name_from_oa')} || ' based on insurance_firm_oa'",
        "last_synced_at": TS}, "match_status = 'PAYER_ID_ONLY'"),
    "correct_name_only": _resolve({
        "payer_id": "(select o.payer_id from oa1 o where o.firm_id = (select min(p.firm_id) from oa1 p where lower(p.name) = lower(annotated.name)))",
        "match_status": "'CORRECTED_NAME_ONLY'",
        "match_details": "'Updated payer_id based on name match with insurance_firm_oa'",
        "last_synced_at": TS}, "match_status = 'NAME_ONLY'"),
    "match_via_sub_payer": _resolve({
        "payer_id": "(select min(o.payer_id) from oa1 o where o.payer_id in (annotated.payer_id_fac, annotated.payer_id_pro, annotated.payer_id_elig))",
        "match_status": "'MATCHED_VIA_SUB_PAYER'",
        "match_details": "'Matched via facility/professional/eligibility payer_id'",
        "last_synced_at": TS}, """match_status = 'NO_MATCH' and coalesce(payer_id_fac in (select payer_id from oa1 where payer_id is not null)
            or payer_id_pro in (select payer_id from oa1 where payer_id is not null)
            or payer_id_elig in (select payer_id from oa1 where payer_id is not null), false)"""),
    "mark_invalid": _resolve({
        "match_status": "'INVALID_PAYER'",
        "match_details": "'No matching record in insurance_firm_oa - marked for deletion'",
        "last_synced_at": TS}, f"match_status = 'NO_MATCH' and {_INVALID}"),
    "add_missing_to_oa": f"""select * from oa1 union all by name
        select row_number() over (order by firm_id) + (select max(firm_id) from oa1) as firm_id, payer_id, name, {PAYLOAD}
        from annotated where match_status = 'NO_MATCH' and payer_id is not null and name is not null""",
    "add_missing_to_oa__candidates": f"""select firm_id, payer_id, name, {IDS} from annotated
        where match_status = 'NO_MATCH' and payer_id is not null and name is not null""",
    "analysis_cache": f"""select firm_id, payer_id as old_payer_id, name as old_name, oa_id,
        {NEW_ID} as new_payer_id, oa_name as new_name, match_status, matched_via from resolved""",
    "analysis_cache__preview": """select match_status, matched_via, count(*) as record_count
        from resolved group by all""",
    "analysis_cache__sync": f"select {TABLE_COLS} from synced",
    "mutation_counts": """select (select count(*) from resolved) as records_updated,
        (select count(*) from firm) - (select count(*) from kept) as records_deleted,
        (select count(*) from fresh) as records_inserted""",
    # views
    "v_review": f"""select firm_id, payer_id as current_payer_id, name as current_name, match_status, match_details,
        correct_name_from_oa as suggested_name, {IDS}, last_synced_at from annotated
        where match_status in ('PAYER_ID_ONLY','NAME_ONLY','NO_MATCH')""",
    "v_review__feed": """select firm_id, payer_id as current_payer_id, name as current_name, match_status, match_details,
        name_from_payers_oa as suggested_name, professional_payer_id, facility_payer_id, eligibility_payer_id,
        last_synced_at from mapped where match_status in ('PAYER_ID_ONLY','NAME_ONLY','NO_MATCH')""",
    "v_mismatches": f"""select {_OLD_NEW_COLS}, sync_details, last_synced_at, {_MISMATCH} as mismatch_type
        from synced where {_DIFFER}""",
    "v_mismatches__listing": f"""select {_OLD_NEW_COLS}, {_MISMATCH} as mismatch_type,
        {source('exists')} as data_availability from synced where {_DIFFER} and sync_status in {REVIEW}""",
    "v_incomplete": f"""select firm_id, payer_id, name, {IDS}, sync_status, matched_via, {missing('severity')} as severity,
        cast((payer_id_fac is not null)::int + (payer_id_pro is not null)::int
        + (payer_id_elig is not null)::int as bigint) as completeness_count from synced where {ANY_NULL}""",
    "v_recent_sync": """select firm_id, payer_id, name, payer_id_new, name_new, matched_via, sync_status, last_synced_at
        from synced where last_synced_at is not null order by last_synced_at desc, firm_id limit 100""",
    "v_payer_id_analysis": f"""select firm_id, name, payer_id as old_payer_id, payer_id_new as new_payer_id, {IDS},
        matched_via, {source('short')} as primary_source, {_COMPARE} as old_vs_new_comparison, sync_status
        from synced where sync_status is not null""",
    "v_sync_dashboard": _stack([
        f"select {lit(t)} as metric, count(*) filter (where {c}) as value, '%' as unit from synced"
        for t, c in zip(v.DASHBOARD_METRICS, (
            "true", "sync_status = 'EXACT_MATCH'", f"sync_status in {REVIEW}", "sync_status = 'NEW_FROM_OA'",
            *(f"{c} is not null" for c in v.ID_COLS)))]),
    "v_needs_review": f"""select firm_id, payer_id, name, payer_id_new, name_new, matched_via, sync_status,
        sync_details, {_REASON} as review_reason from synced where {_NEEDS_REVIEW}""",
    "v_needs_review__count": f"select count(*) as review_count from synced where {_NEEDS_REVIEW}",
    "v_needs_review__top": f"""select firm_id, payer_id, name, {_REASON} as review_reason, sync_status from synced
        where {_NEEDS_REVIEW} order by review_reason, name nulls first, firm_id limit 10""",
    "stream_sync": f"""select {TABLE_COLS} from updated
        union all by name select {TABLE_COLS} from inserted""",
    "run_sync": f"select {TABLE_COLS} from synced",
    "run_sync__option_c_reference": f"select {TABLE_COLS} from shaken",
    "run_sync__published": f"select {TABLE_COLS} from synced",
    "run_sync__option_b_patients": "select * from moved",
    "run_sync__bucketed": f"select {TABLE_COLS} from synced",
    "rollback__bucketed": f"select {TABLE_COLS} from tracked",
    "rollback__version": "select * from tracked",
    "snapshot__restore": "select * from firm",
    "run_usage_cleanup__published": f"select {TABLE_COLS} from cleaned_ref",
    "run_usage_cleanup": f"select {TABLE_COLS} from cleaned_ref",
    "run_usage_cleanup__safe": f"select {TABLE_COLS} from cleaned_safe",
}
for _name, _table in (("row_counts", "firm"), ("row_counts__after_sync", "synced")):
    S[_name] = f"""select *, {bands('difference', v.ROW_DIFF_INSERT)} as status,
        {bands('difference', v.ROW_DIFF_SUMMARY)} as summary_status from (
        select count(*) as insurance_firm_count, count(payer_id) as firms_with_payer_id, count(name) as firms_with_name,
        {_N['oa']} as insurance_firm_oa_count, {_N['pat']} as patient_insurance_count,
        count(*) - {_N['oa']} as signed_difference, abs(count(*) - {_N['oa']}) as difference from {_table})"""


def _duplicates(table, key, value, label) -> str:
    return f"""select distinct t.{key}, t.duplicate_count, d.v as {label} from (
        select {key}, count(*) as duplicate_count from {table} where {key} is not null group by 1
        having count(*) > 1 order by 2 desc, 1 limit 10) t
        left join (select distinct {key}, {value} as v from {table} where {value} is not null) d on d.{key} = t.{key}"""


S["duplicate_keys"] = _duplicates("firm", "payer_id", "name", "different_name")
S["duplicate_keys__oa_payer_ids"] = _duplicates("oa1", "payer_id", "name", "different_name")
S["duplicate_keys__oa_names"] = _duplicates("oa", "name", f"coalesce({NEW_ID}, 'NULL')", "different_payer_id")


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, sql in S.items():
        if sql.startswith("with "):
            # Blocks go first, then the statement's own.
            out[name] = build(sql).replace("\nwith ", ",\n", 1)
        else:
            out[name] = build(sql)
    return out
