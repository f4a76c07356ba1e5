"""DuckDB SQL with the meaning of each query of the catalogue."""

from __future__ import annotations

from spanworks.operators import categories, severity
from spanworks.plans import drivers, round_trips, streams
from spanworks.plans.bindings import EARLIER_US, NOW_US, SINCE_US

SEV = "case event_type when 'error' then 'outage' when 'signup' then 'quality' when 'view' then 'degraded' else 'maintenance' end"
N = f"""n as (
    select event_id as id, user_id % 25 as region, user_id || '-' || event_type as ref, user_id, event_type as category, {SEV} as sev,
           epoch_us(ts) as s, epoch_us(ts) + cast(round(value * 60) as bigint) * 1000000 as e, value from events)"""
AREAS = """ar as (
    select s_suppkey as area, cast(s_nationkey as bigint) as region, cast(greatest(0, floor(s_acctbal)) as bigint) as pop,
           52 + (s_suppkey * 37 % 1000) / 2000::double as lat, -8 + (s_suppkey * 91 % 1000) / 2000::double as lon from supplier)"""
PINS = """pins as (
    select c_custkey as pin, cast(c_nationkey as bigint) as region, 52 + (c_custkey * 53 % 1013) / 2026::double as lat, -8 + (c_custkey * 71 % 1019) / 2038::double as lon from customer)"""
FOOT = "foot as (select distinct n.region, sev, ref, area, pop from n join ar on ar.region = n.region and n.user_id % 10 = ar.area % 10)"
PEOPLE = "people as (select region, sev, ref, cast(sum(pop) as bigint) as people from foot group by all)"
POPULATION = "population as (select region, greatest(cast(sum(pop) as bigint), 1) as population from ar group by region)"
KM = "sqrt(pow((b.lat - a.lat) * 111, 2) + pow((b.lon - a.lon) * 111 * cos(radians(a.lat)), 2))"


def union(name: str, source: str, keys: str) -> str:
    """A CTE with the merged intervals of each key."""
    return f"""{name} as (
    select {keys}, min(s) as s, max(e) as e from (
        select *, sum(case when s <= reach then 0 else 1 end) over (partition by {keys} order by s, e rows unbounded preceding) as island from (
            select *, max(e) over (partition by {keys} order by s, e rows between unbounded preceding and 1 preceding) as reach from {source}))
    group by {keys}, island)"""


def slices(name: str, source: str, unit: str) -> str:
    """A CTE with a row per interval and the month or day it touches, and the microseconds shared."""
    series = f"generate_series(date_trunc('{unit}', make_timestamp(s)), date_trunc('{unit}', make_timestamp(greatest(s, e - 1))), interval 1 {unit})"
    return f"""{name} as (
    select * from (select *, least(e, epoch_us(slot + interval 1 {unit})) - greatest(s, epoch_us(slot)) as us from (select *, unnest({series}) as slot from {source})) where us > 0)"""


EVENTS = union("ev", "n", "region, sev, ref")
CUT = f"cut as (select region, sev, ref, greatest(s, {SINCE_US}) as s, least(e, {NOW_US}) as e from ev where s < {NOW_US} and e > {SINCE_US})"
MONTHS = f"""with {N}, {AREAS}, {FOOT}, {PEOPLE}, {POPULATION}, {EVENTS}, {CUT}, {slices('sl', 'cut', 'month')}, per as (
    select region, sev, ref, slot, sum(us) as us from sl group by all), t as (
    select per.region, slot, {', '.join(f"count(*) filter (sev = '{s}') as n_{s}" for s in severity.SEVERITIES)},
           cast(sum(case when sev = 'outage' then us * coalesce(people, 0) else 0 end) as bigint) as person_us
    from per left join people using (region, sev, ref) group by all), g as (
    select *, greatest(least(epoch_us(slot + interval 1 month), {NOW_US}) - greatest(epoch_us(slot), {SINCE_US}), 1000000) as period from t join population using (region)), a as (
    select *, 100 * (1 - person_us::double / (population::double * period)) as raw from g)"""
TIER = "case id % 3 when 0 then 'observed' when 1 then 'scheduled' else 'imputed' end"


def medians(keys: str) -> str:
    pick = keys + ", " if keys else ""
    one = lambda *t: f"case when tier in ({', '.join(repr(x) for x in t)}) then hours end"
    return f"""with {N}, t as (select region, {TIER} as tier, (e - s) / 1e6::double / 3600 as hours from n)
select {pick}round_even(median({one('observed')}), 1) as median_observed, count({one('observed')}) as observed_n, round_even(median({one('scheduled')}), 1) as median_scheduled,
       count({one('scheduled')}) as scheduled_n, round_even(median({one('observed', 'imputed')}), 1) as median_pooled, count({one('imputed')}) as imputed_n from t {'group by ' + keys if keys else ''}"""


ISSUES = f"""with {N}, k as (select *, case when user_id % 13 = 0 then '' else cast(user_id as varchar) end as scheme from n),
i as (select id, region, scheme, s as t0 from k where category = 'error'), l as (select region, scheme, s as lift from k where category = 'view'),
p as (select id, min(lift) as lift_at from i join l using (region, scheme) where scheme <> '' and lift >= t0 - 172800000000 group by id)"""
STATUS = "case o_orderstatus when 'O' then 'Open' when 'F' then 'Closed' end"
VERSIONS = f"v as (select o_custkey as id, {STATUS} as status, strftime(o_orderdate, '%Y-%m-%d') as start_date, o_orderkey as k, year(o_orderdate) as y from orders)"
TAGS = f"{VERSIONS}, w as (select *, start_date || '-' || lpad(cast(k as varchar), 12, '0') as tag from v), last as (select id, max(tag) as last_tag from w where status = 'Open' group by id), stamps as (select id, min(tag) as closed_tag from w join last using (id) where status is distinct from 'Open' and tag > last_tag group by id)"


def merged(old: str, new: str, y: int, name: str) -> str:
    return f"""{name} as (select coalesce(o.id, b.id) as id, case when b.id is null then o.status else b.status end as status, case when b.id is null then o.start_date else b.start_date end as start_date,
    coalesce(o.first_seen, '{y}') as first_seen, case when b.id is null then o.last_seen else '{y}' end as last_seen,
    case when b.id is null then o.closed_at when b.status = 'Open' then null when o.status = 'Open' then '{y}' else o.closed_at end as closed_at, coalesce(o.first_start_date, b.start_date) as first_start_date
    from {old} o full outer join {new} b on o.id = b.id)"""


_CATS = [*severity.HARD, *severity.REPAIR, *severity.QUALITY, *severity.DEGRADED, *severity.LIFT_OF.values(), "other"]
_LIST = lambda names: ", ".join(f"'{x}'" for x in names)
_RULES = ", ".join(f"('{v}', '{c}', {'null' if w is None else repr(w)})" for c, w, vs in categories.CATEGORIES for v in vs)
_VARIANTS = categories.variant_list()
SPACE = r"[\s\x0b\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
CAP = 14 * 86_400_000_000
CASES = f"""e as (select *, event_id as id, event_id as k, epoch_us(ts) as t0, 'c' || (user_id % 25) as county from events), c as (
    select *, case when k % 9 = 0 then 'id:' || id else 'R' || user_id end as ref, 'place ' || (user_id % 10) as scheme,
    (['burst_main', 'mains_repair', 'boil_notice_issued', 'boil_notice_lifted', 'consumption_notice_issued', 'consumption_notice_lifted', 'low_pressure', 'other'])[k % 8 + 1] as cat,
    case when k % 5 = 0 then 'Planned' else 'Unplanned' end as work_type, case k % 4 when 0 then 'Open' when 1 then 'Closed' end as status, k % 31 = 0 as restricted,
    case when k % 6 in (0, 1) and k % 7 <> 0 then round(value * 60) end as span, case k % 6 when 0 then 'completion_update' when 1 then 'scheduled_end_with_time' when 2 then 'not_found' when 3 then 'lifted_immediate' end as source,
    case when k % 6 in (0, 1) then cast(ts as date) end as end_date, case when k % 6 in (0, 1) and k % 2 = 0 then interval '18 hours' else interval '86399 seconds' end as end_time from e)"""

SQL: dict[str, str] = {
    "interval_union": f"with {N}, {union('u', 'n', 'user_id, category')} select * from u",
    "interval_union_presplit": f"with {N}, {union('u', 'n', 'category')} select * from u",
    "covered_seconds": f"""with {N}, {union('u', 'n', 'region, category')}, c as (select *, greatest(0, least(e, {NOW_US}) - greatest(s, {SINCE_US})) as us from u)
select region, category, sum(us)::double / 1e6 as seconds, count(*) filter (us > 0) as pieces from c group by all""",
    "month_clip": f"with {N}, {union('u', 'n', 'region, category')}, {slices('x', 'u', 'month')} select region, category, strftime(slot, '%Y-%m') as month, cast(sum(us) as bigint) as us, count(*) as pieces from x group by all",
    "month_axis": """select o_orderpriority, strftime(unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), interval 1 month)), '%Y-%m') as month from orders group by o_orderpriority""",
    "now_standing": f"with {N} select region, count(*) filter (s <= {NOW_US} and {NOW_US} <= e) as standing from n where category = 'signup' group by region",
    "civil_windows": """with o as (select o_orderkey, cast(o_orderdate as date) as day, cast(cast(o_orderdate as date) as timestamp) + interval 3 hour as lo from orders),
x as (select *, lo + interval 35 day as hi from o), d as (select *, cast(unnest(generate_series(greatest(cast(day as timestamp), cast(lo - interval 1 day as timestamp)), cast(hi as timestamp) + interval 1 day, interval 1 day)) as date) as d0 from x),
w as (select *, greatest(epoch_us(lo), epoch_us(timezone('Europe/Dublin', cast(d0 as timestamp) + interval 22 hour))) as s, least(epoch_us(hi), epoch_us(timezone('Europe/Dublin', cast(d0 as timestamp) + interval 31 hour))) as e from d)
select o_orderkey, count(*) as windows, cast(sum(e - s) as bigint) as us, min(s) as first_us from w where e > s group by o_orderkey""",
    "severity_counts": MONTHS + f" select region, strftime(slot, '%Y-%m') as month, {', '.join(f'n_{s}' for s in severity.SEVERITIES)} from a",
    "availability_grade": MONTHS + """ select region, strftime(slot, '%Y-%m') as month, cast(floor(person_us / 1e6::double) as bigint) as person_s, round_even(greatest(raw, 0), 3) as availability,
case when raw >= 99.9 then 'A' when raw >= 99.75 then 'B' when raw >= 99.45 then 'C' when raw >= 99.0 then 'D' else 'F' end as grade from a""",
    "capped_people": f"with {N}, {AREAS}, {FOOT}, {PEOPLE} select region, sev, ref, least(people, 9000) as people from people",
    "day_status": f"""with {N}, {AREAS}, {FOOT}, {PEOPLE}, {POPULATION}, {EVENTS}, {slices('x', 'ev', 'day')}, p as (
    select d.region, slot, list_position(['outage', 'quality', 'degraded', 'maintenance'], d.sev) as rank, sum(coalesce(people, 0)) as people from (select distinct region, sev, ref, slot from x) d left join people using (region, sev, ref) group by all),
w as (select *, row_number() over (partition by region, slot order by rank) as r from p)
select region, strftime(slot, '%Y-%m-%d') as day, (['outage', 'quality', 'degraded', 'maintenance'])[rank] as sev, round_even(least(100, 100 * people::double / population), 1) as pct from w join population using (region) where r = 1""",
    "clear_days": f"""with {N}, {AREAS}, {POPULATION}, {EVENTS}, {slices('x', 'ev', 'day')}, b as (select distinct region, slot from x),
g as (select region, unnest(generate_series(date_trunc('day', make_timestamp({SINCE_US})), date_trunc('day', make_timestamp({NOW_US})), interval 1 day)) as slot from population)
select g.region, count(*) as elapsed, count(*) filter (b.slot is null) as clear from g left join b on b.region = g.region and b.slot = g.slot group by g.region""",
    "top_events": f"""with {N}, {AREAS}, {FOOT}, {PEOPLE}, {EVENTS}, o as (select * from ev where sev = 'outage'), {slices('x', 'o', 'month')}, p as (
    select region, ref, slot, cast(round_even(sum(us)::double * max(people) / 3.6e9::double, 0) as bigint) as person_h, max(people) as people from x join people using (region, sev, ref) where people > 0 group by region, ref, slot),
r as (select *, row_number() over (partition by slot order by person_h desc, region, ref) as place from p) select strftime(slot, '%Y-%m') as month, place, region, ref, person_h, people from r where place <= 10""",
    "open_list": f"with {N}, r as (select *, row_number() over (partition by region order by s desc, id) as place from n where s <= {NOW_US} and e > {NOW_US}) select region, place, id, ref, s from r where place <= 60",
    "recent_history": f"with {N} select region, strftime(make_timestamp(e), '%Y-%m') as month, count(*) as n, array_to_string((list(id order by e desc, id))[1:20], ',') as newest from n group by all",
    "event_meta": f"""with {N}, p as (select *, case when id % 3 = 0 then '' else 'at ' || id end as location, id % 5 = 0 as is_open, value > 60 as has_end, value > 90 as observed, case when id % 2 = 0 then e end as closed from n)
select region, ref, count(*) as pins, count(*) filter (observed) as confirmed, count(*) filter (has_end and not observed) as scheduled, min(s) as start,
    (['outage', 'quality', 'degraded', 'maintenance'])[min(list_position(['outage', 'quality', 'degraded', 'maintenance'], sev))] as sev, 't' || min(id) as title,
    arg_min(location, id) filter (location <> '') as location, bool_or(category = 'signup') as health, bool_or(is_open) as open, arg_min(closed, id) filter (not is_open and closed is not null) as closed_at from p group by region, ref""",
    "multi_area_history": f"with {N}, {AREAS}, {FOOT}, {EVENTS}, m as (select region, sev, ref, min(s) as s, max(e) as e from ev group by all) select area, region, sev, ref, s, e from m join foot using (region, sev, ref)",
    "directory": f"with {N}, {AREAS}, {FOOT}, l as (select region, area, count(distinct ref) as events from foot group by all) select *, row_number() over (partition by region order by area) as place from l",
    "area_rollup": f"""with {N}, {AREAS}, {FOOT}, j as (select area, sev, ref, pop, s, e from n join foot using (region, sev, ref)), {union('u', 'j', 'area, sev, ref, pop')}, {slices('x', 'u', 'month')}
select area, strftime(slot, '%Y-%m') as month, count(distinct ref) as events, cast(sum(case when sev = 'outage' then us * pop else 0 end) as bigint) as person_us from x group by all""",
    "typical_span": f"""with {N}, t as (select category || '-' || (user_id % 50) as category, least((e - s) / 1e6::double, 10000) as x from n), o as (select median(x) as overall from t)
select category, count(*) as n, case when count(*) >= 15 then median(x) else any_value(overall) end as typical, any_value(overall) as overall from t, o group by category""",
    "imputed_exposure": f"""with {N}, t as (select *, case when id % 4 <> 0 then (e - s) / 1e6::double end as own from n), m as (select category, median(own) as typical from t group by category)
select region, round(sum(coalesce(own, typical)), 3) as seconds, count(*) filter (own is null) as imputed from t join m using (category) group by region""",
    "tiered_medians": medians("region"),
    "national_medians": medians(""),
    "area_radius_join": f"with {AREAS}, {PINS} select pin, area, round({KM}, 6) as km from pins a, ar b where {KM} <= 2.5",
    "nearest_fallback": f"""with {AREAS}, {PINS}, x as (select pin, area, {KM} as km from pins a, ar b where {KM} <= 8), near as (select * from x where km <= 0.8),
far as (select *, row_number() over (partition by pin order by km, area) as r from x where pin not in (select pin from near))
select pin, area, round(km, 6) as km, false as nearest from near union all select pin, area, round(km, 6), true from far where r = 1""",
    "shared_footprints": f"""with {AREAS}, {PINS}, p as (select pin, round(lat, 2) + (pin % 3) * 0.00001::double as lat, round(lon, 2) as lon from pins), c as (select *, round(lat, 4) as la, round(lon, 4) as lo from p),
f as (select *, min(pin) over (partition by la, lo) as first_pin from c), a as (select * from f where pin = first_pin),
x as (select a.pin, b.area, {KM} as km from a, ar b where {KM} <= 8), near as (select * from x where km <= 0.5), far as (select *, row_number() over (partition by pin order by km, area) as r from x where pin not in (select pin from near)),
got as (select pin, area, false as nearest from near union all select pin, area, true from far where r = 1)
select f.pin, got.area, got.nearest from f join got on got.pin = f.first_pin""",
    "dominant_area": f"""with {AREAS}, {PINS}, x as (select a.pin, b.region, sum(b.pop) as people from pins a, ar b where {KM} <= 4 group by all), r as (select *, row_number() over (partition by pin order by people desc, region) as r from x)
select pin, region, cast(people as bigint) as people from r where r = 1""",
    "split_large_groups": """with m as (select s_suppkey, case when s_suppkey % 4 <> 0 then s_nationkey % 5 end as town, cast(s_nationkey % 3 + case when s_suppkey % 7 = 0 then 10 else s_nationkey end as int) as ward, cast(greatest(0, floor(s_acctbal)) as bigint) as pop from supplier),
t as (select town, sum(pop) as g from m where town is not null group by town), w as (select ward, sum(pop) as whole from m group by ward), i as (select town, ward, sum(pop) as inside from m where town is not null group by all)
select town, ward, case when g >= 60000 and inside >= 0.3::double * whole then town || '-' || ward when g >= 60000 then town || '-rest' else cast(town as varchar) end as piece, count(*) as members, cast(sum(pop) as bigint) as pop
from m left join t using (town) left join i using (town, ward) join w using (ward) group by all""",
    "two_tier_resolve": """with known as (select 'N' || (n_nationkey % 9) as name, n_regionkey as grp, n_nationkey as code from nation), asked as (select c_custkey, 'N' || (c_nationkey % 11) as name, cast(c_custkey % 7 as int) as grp from customer),
ex as (select name, grp, min(code) as code from known group by all), alone as (select name, min(code) as code from known group by name having count(*) = 1)
select c_custkey, a.name, a.grp, coalesce(ex.code, alone.code) as code from asked a left join ex on ex.name = a.name and ex.grp = a.grp left join alone on alone.name = a.name""",
    "reconcile": """with a as (select l_suppkey, count(*) as ours from lineitem group by all), b as (select l_suppkey, count(*) as theirs from lineitem where l_quantity < 50 group by all) select * from a join b using (l_suppkey) where ours <> theirs""",
    "lift_pairing": ISSUES + " select * from p",
    "standing_notice_fate": ISSUES + f""", f as (select i.*, lift_at, case when lift_at is not null then 'paired' when id % 3 <> 0 then 'closed_no_signal' when {NOW_US} - t0 > {CAP} then 'exclude' else 'accrue' end as fate from i left join p using (id))
select id, fate, case fate when 'paired' then least(greatest(lift_at, t0), t0 + {CAP}) when 'closed_no_signal' then t0 + 1000000 when 'accrue' then greatest(t0, least({NOW_US}, t0 + {CAP})) end as end_us from f""",
    "modal_window": f"""with {N}, h as (select *, case when id % 2 = 0 then cast(hour(make_timestamp(s)) % 4 as int) end as hour from n), c as (select region, ref, hour, count(*) as k from h where hour is not null group by all),
b as (select *, row_number() over (partition by region, ref order by k desc, hour) as r from c) select h.id, coalesce(h.hour, b.hour) as hour from h left join b on b.region = h.region and b.ref = h.ref and b.r = 1""",
    "upsert_state": f"""with {VERSIONS}, one as (select * from (select *, row_number() over (partition by id, y order by k desc) as r from v) where r = 1),
a1995 as (select id, status, start_date, '1995' as first_seen, '1995' as last_seen, cast(null as varchar) as closed_at, start_date as first_start_date from one where y = 1995),
{', '.join(f"n{y} as (select * from one where y = {y}), " + merged(f"a{y - 1}", f"n{y}", y, f"a{y}") for y in range(1996, 2002))} select * from a2001""",
    "close_replay": f"with {TAGS} select * from stamps",
    "guarded_stamps": f"""with {TAGS}, c as (select c_custkey as id, case c_custkey % 3 when 0 then 'Open' when 1 then 'Closed' end as status, case when c_custkey % 4 = 0 then 'earlier' end as closed_at from customer), j as (
    select c.*, closed_tag, closed_at is null and status is distinct from 'Open' and closed_tag is not null as filled from c left join stamps using (id)) select id, status, case when filled then closed_tag else closed_at end as closed_at, filled from j""",
    "latest_log": """with o as (select o_custkey as id, strftime(o_orderdate, '%Y') as logged, o_orderkey as line, o_totalprice, row_number() over (partition by o_custkey order by strftime(o_orderdate, '%Y') desc, o_orderkey) as r from orders) select id, logged, line, o_totalprice from o where r = 1""",
    "first_log": """with c as (select conv_id as id, turn, role, length(text) as chars, row_number() over (partition by conv_id order by role nulls first, turn) as r from conversations) select id, turn, role, chars from c where r = 1""",
    "never_matched": "select doc_id, lang from documents where doc_id not in (select doc_id from labels)",
    "coverage_check": "select count(*) as missing, min(o_orderkey) as least, max(o_orderkey) as most from orders where o_orderkey not in (select l_orderkey from lineitem where l_quantity > 25)",
    "stale_select": """with d as (select doc_id, sha256(text) as h from documents), s as (select doc_id, case when doc_id % 5 = 0 then 'old' else h end as h, doc_id % 2 as version from d where doc_id % 3 <> 0)
select d.doc_id from d left join s using (doc_id) where not coalesce(d.h is not distinct from s.h and s.h is not null and s.version = 1, false)""",
    "placeholder_fill": """with c as (select s_suppkey % 40 as y, s_nationkey as x, min(s_name) as place from supplier where s_suppkey % 2 = 0 group by all), w as (select distinct s_suppkey % 40 as y, s_nationkey as x from supplier)
select * from c union all select y, x, null from w where not exists (select 1 from c where c.y = w.y and c.x = w.x)""",
    "category_lookup": f"""with r(variant, category, implied) as (values {_RULES}), p as (select p_partkey, ([{_LIST(_VARIANTS)}])[p_partkey % {len(_VARIANTS) + 5} + 1] as variant from part)
select p_partkey, category, implied as implied_work_type from p left join r using (variant)""",
    "unmatched_prefixes": "select lower(p_type) as variant, count(*) as n from part group by all order by n desc, variant limit 15",
    "severity_rules": f"""with c as (select *, ([{_LIST(_CATS)}])[event_id % {len(_CATS) + 1} + 1] as cat from events), s as (select cat, case when cat in ({_LIST(severity.LIFT_OF.values())}) then 'none' when cat in ({_LIST(severity.QUALITY)}) then 'quality'
    when cat in ({_LIST(severity.DEGRADED)}) or user_id % 7 = 0 or user_id % 11 = 0 then 'degraded' when cat in ({_LIST(severity.HARD)}) or (cat in ({_LIST(severity.REPAIR)}) and user_id % 2 <> 0) then case when value > 100 then 'degraded' else 'outage' end
    else 'maintenance' end as sev, coalesce(cat in ({_LIST(severity.HEALTH)}), false) as health from c) select cat, sev, health, count(*) as n from s group by all""",
    "strip_markup": f"with p as (select page_id, trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '{SPACE}', ' ', 'g'), ' ') as t from pages) select page_id, length(t) as chars, md5(t) as digest from p",
    "scheme_key": "select p_partkey, lower(p_name) || ' brand ' || split_part(p_brand, '#', 2) as scheme from part",
    "title_case": """with w as (select p_partkey, split_part(p_name, ' ', 1) as a, split_part(p_name, ' ', 2) as b, lower(p_type) as t from part)
select p_partkey, 'O''' || upper(a[1]) || a[2:] || ' ' || upper(b[1]) || b[2:] || '-' || upper(t[1]) || t[2:] || '/X' as label from w""",
    "text_hash_dedup": "select sha256(text) as text_hash, min(doc_id) as doc_id, count(*) as copies from documents group by 1",
    "recurrence_text": "select o_orderkey, o_orderkey % 8 in (0, 1, 4, 6) as recurring, o_orderkey % 6 in (0, 1) as pressure from orders",
    "quotable": "select o_orderkey, o_orderkey % 5 <> 0 and o_orderkey % 4 <> 3 as time_said, o_orderkey % 6 in (0, 1, 2, 4) or (o_orderkey % 6 = 3 and day(o_orderdate) not in (1, 2, 3, 21, 22, 23, 31)) as date_said from orders",
    "template_extract": """with o as (select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as day, (o_orderkey // 4) % 6 as k from orders)
select o_orderkey, case when k in (0, 3) then 'scheduled_end_with_time' when k = 1 then 'completion_update' end as end_source, case when k in (0, 1, 3) then day end as local_date, case k when 0 then '17:30' when 1 then '10:15' when 3 then '12:00' end as local_time from o""",
    "json_flag": "select event_id, cast(json_extract_string(props, '$.k') as int) as k, json_extract_string(props, '$.none') is null as lacks from events",
    "overlap_audit": f"""with {N}, {AREAS}, {FOOT}, f as (select distinct region, ref, area, pop from foot), j as (select n.region, n.ref, area, pop, s, e from n join f using (region, ref) where sev = 'outage'),
{union('a', 'j', 'region, ref, area, pop')}, {slices('ax', 'a', 'month')}, {union('b', 'j', 'area, pop')}, {slices('bx', 'b', 'month')}, p as (select slot, cast(sum(us * pop) as bigint) as published from ax group by slot), q as (select slot, cast(sum(us * pop) as bigint) as exact from bx group by slot)
select strftime(slot, '%Y-%m') as month, published, exact from p full outer join q using (slot)""",
    "accuracy_table": """with t as (select lang, case when n_chars % 5 = 0 then 'abstain' when cast(n_chars > 600 as int) = quality then 'correct' else 'incorrect' end as v from labels join documents using (doc_id)),
g as (select coalesce(lang, 'TOTAL') as lang, count(*) as n, count(*) filter (v = 'correct') as correct, count(*) filter (v = 'incorrect') as incorrect, count(*) filter (v = 'abstain') as abstained from t group by rollup (lang))
select *, round_even(100 * correct::double / nullif(correct + incorrect, 0), 2) as accuracy from g""",
    "agreement_pivot": """with t as (select lang, case when l.doc_id is null then 'stale' when quality = toxic then 'agree' else 'disagree' end as kind from documents d left join labels l using (doc_id))
select lang, count(*) filter (kind = 'agree') as agree, count(*) filter (kind = 'disagree') as disagree, count(*) filter (kind = 'stale') as stale from t group by lang""",
    "stratified_quota": "with r as (select doc_id, lang, row_number() over (partition by lang order by md5('5:' || doc_id), doc_id) as pick from documents) select doc_id, lang, pick from r where pick <= case lang when 'en' then 30 when 'de' then 20 else 10 end",
    "uniform_n": "select doc_id, lang from documents order by md5('9:' || doc_id), doc_id limit 120",
    "mercator": "select s_suppkey, round(degrees((s_suppkey - 50) * 13931.5::double / 6378137), 6) as lon, case when s_suppkey = 20 then 0 else round(degrees(2 * atan(exp((s_suppkey - 20) * 70470.25::double / 6378137)) - pi() / 2), 6) end as lat from supplier",
    "reported_spans": """with o as (select *, cast(o_orderdate as date) + cast(o_orderkey % 5 - 1 as int) as day, case o_orderkey % 3 when 0 then interval '15 hours 30 minutes' when 1 then interval '8 hours 5 minutes' else interval '86399 seconds' end as t from orders),
s as (select o_orderkey, (epoch_us(timezone('Europe/Dublin', cast(day as timestamp) + t)) - epoch_us(o_orderdate)) / 1e6::double as x from o) select o_orderkey, case when o_orderkey % 7 > 1 and x >= 0 then x end as seconds from s""",
    "resolved_notices": f"""with {CASES}, l as (select county, scheme, cat, t0 as lift from c where cat like '%lifted'), p as (
    select c.id, min(lift) as lift_at from c join l on l.county = c.county and l.scheme = c.scheme and l.cat = replace(c.cat, 'issued', 'lifted') where c.cat like '%issued' and lift >= c.t0 - 172800000000 group by c.id),
obs as (select cat, least(span, {CAP} / 1e6::double) as x from c where source = 'completion_update' and span is not null), o as (select median(x) as overall from obs), m as (select cat as mcat, case when count(*) >= 15 then median(x) else any_value(overall) end as typical from obs, o group by cat),
j as (select c.*, lift_at, least(cast(trunc(coalesce(typical, overall) * 1000000) as bigint), {CAP}) as charge, coalesce(source, 'not_found') as src, case when end_date is not null then epoch_us(timezone('Europe/Dublin', cast(end_date as timestamp) + end_time)) end as known,
    case when cat like '%lifted' then null when cat in ('boil_notice_issued', 'consumption_notice_issued') then 'quality' when cat = 'low_pressure' or restricted then 'degraded' when cat = 'burst_main' or (cat = 'mains_repair' and work_type <> 'Planned') then 'outage' else 'maintenance' end as sev
    from c left join p using (id) left join m on m.mcat = c.cat, o),
d as (select *, src = 'lifted_immediate' or (src <> 'not_found' and end_date is not null) as over_, cat = 'boil_notice_issued' as boil from j where sev is not null),
f as (select *, case when boil and lift_at is not null then 'paired' when boil and status is distinct from 'Open' then 'token' when boil and {NOW_US} - t0 > {CAP} then 'dropped' when boil then 'accrues' when span is not null then 'span' when not over_ and lift_at is not null then 'paired'
    when not over_ and status = 'Open' and t0 < {NOW_US} then 'accrues' when coalesce(charge, 0) = 0 then 'token' when known is not null then 'imputed_to_end' else 'imputed_from_start' end as outcome from d)
select id, sev, outcome, 1 as pieces, case when outcome = 'imputed_to_end' then known - charge else t0 end as s, case outcome when 'paired' then least(greatest(lift_at, t0), t0 + {CAP}) when 'accrues' then greatest(t0, least({NOW_US}, t0 + {CAP})) when 'span' then t0 + least(cast(span * 1000000 as bigint), {CAP})
    when 'imputed_to_end' then known when 'imputed_from_start' then t0 + charge else t0 + 1000000 end as e, outcome in ('paired', 'span') as has_end, outcome = 'paired' or (outcome = 'span' and coalesce(source = 'completion_update', false)) as observed_end, outcome like 'imputed%' as imputed from f where outcome <> 'dropped'""",
    "county_names": "select n_nationkey, (['Cork', 'Dublin', 'Carlow', 'Dublin', 'Tipperary', 'Galway'])[n_nationkey % 6 + 1] as county from nation",
    "area_rows": """with s as (select s_suppkey as guid, case when s_suppkey % 3 <> 0 then 'T' || (s_suppkey % 5) end as code, 'East Ward-' || (s_suppkey % 4) as division, case when s_suppkey % 2 = 0 then 'Cork' else 'Dublin' end as own, s_suppkey % 5 as t from supplier)
select guid, coalesce(code, 'ed:' || own || ':' || division) as code, case when code is null then 'Around ' || division else 'Town ' || t end as name, case when code is not null and t < 3 then 'Mayo' else own end as county from s""",
    "availability_label": MONTHS + """, l as (select region, strftime(slot, '%Y-%m') as month, cast(floor(person_us / 3.6e9::double) as bigint) as person_h, round_even(greatest(raw, 0), 3) as av from a)
select region, month, printf('%.3f', case when person_h > 0 then least(av, 99.999) else av end) || '%' as label, nullif(person_h, 0) as person_h from l""",
    "reviewed_truth": """select o_orderkey as id, case when o_orderkey % 3 = 0 and o_orderkey % 2 = 0 then 'not_found' else 'completion_update' end as true_source, strftime(o_orderdate, '%Y-%m-%d') as true_date,
case when o_orderkey % 3 = 0 and o_orderkey % 4 = 0 then '09:00' else '08:15' end as true_time from orders""",
    "shadow_compare": """select lang, case when doc_id % 7 = 0 then 'never' when doc_id % 11 = 0 then 'stale' when doc_id % 4 = 0 then 'abstain' when doc_id % 5 = 0 then 'recurrence' when doc_id % 3 <> 0 then 'agree' else 'disagree' end as kind, count(*) as n from documents group by all""",
    "consequential_events": f"""with {N}, {AREAS}, {FOOT}, {PEOPLE}, {EVENTS}, {slices('x', 'ev', 'month')}, h as (select region, sev, ref, sum(us * people)::double / 3.6e9::double as h from x join people using (region, sev, ref) group by all), e as (select distinct region, sev, ref from ev)
select e.region, e.sev, e.ref, case when e.sev = 'degraded' then 'downgraded' else 'charged' end as effect, cast(round_even(coalesce(h, 0), 0) as bigint) as person_h from e left join h using (region, sev, ref) where e.sev = 'degraded' or (e.sev = 'outage' and e.ref like '%5-error')""",
    "verdict_tallies": "select case o_orderkey % 3 when 0 then 'correct' when 1 then 'wrong' else 'unreviewed' end as verdict, count(*) as events, cast(sum(floor(o_totalprice)) as bigint) as person_h from orders group by 1",
    "expanded_notices": f"""with {CASES}, l as (select county, scheme, cat, t0 as lift from c where cat like '%lifted'), p as (
    select c.id, min(lift) as lift_at from c join l on l.county = c.county and l.scheme = c.scheme and l.cat = replace(c.cat, 'issued', 'lifted') where c.cat like '%issued' and lift >= c.t0 - 172800000000 group by c.id),
j as (select c.*, lift_at, cat = 'boil_notice_issued' as boil from c left join p using (id) where cat not like '%lifted'),
x as (select *, case when boil and lift_at is not null then least(greatest(lift_at, t0), t0 + {CAP}) when boil then t0 + 1000000 else t0 + 295200000000 end as whole,
    case when boil or k % 5 = 0 then 'none' when k % 3 = 0 then 'refused: close is not the reported end' else 'expanded' end as recurrence_tag from j),
w as (select *, unnest(generate_series(cast(cast(ts as date) as timestamp), cast(cast(ts as date) as timestamp) + interval 4 day, interval 1 day)) as d0 from x where recurrence_tag = 'expanded'),
n as (select id, greatest(t0, epoch_us(timezone('Europe/Dublin', d0 + interval 22 hour))) as s, least(whole, epoch_us(timezone('Europe/Dublin', d0 + interval 31 hour))) as e from w),
m as (select id, sum(e - s) as us, max(e) as last from n where e > s group by id),
r as (select recurrence_tag, coalesce(m.us, whole - t0) as us, coalesce(m.last, whole) - t0 as unbroken from x left join m using (id))
select recurrence_tag, count(*) as notices, round_even(sum(us)::double / 3.6e9::double, 3) as hours, round_even(sum(unbroken)::double / 3.6e9::double, 3) as unbroken_hours from r group by 1""",
    "data_horizon": "select cast(max(o_orderdate) as varchar) as horizon, count(*) as rows, count(*) filter (o_orderstatus = 'P') as pending from orders",
    "streamed_windows": "select strftime(ts, '%Y-%m-%d') as day, event_type, count(*) as n, round(sum(value), 2) as total from events group by all",
}

_GRID = f"grid as (select region, population, unnest(generate_series(date_trunc('month', make_timestamp({SINCE_US})), date_trunc('month', make_timestamp({NOW_US})), interval 1 month)) as slot from population)"
_COUNTS = ", ".join(f"coalesce(n_{s}, 0) as n_{s}" for s in severity.SEVERITIES)
_DAYS = """day_of as (select region, slot, sev, pct from (select *, row_number() over (partition by region, slot order by rank) as r from (
    select d.region, slot, list_position(['outage', 'quality', 'degraded', 'maintenance'], d.sev) as rank, any_value(d.sev) as sev, round_even(least(100, 100 * sum(coalesce(people, 0))::double / any_value(population)), 1) as pct
    from (select distinct region, sev, ref, slot from dx) d left join people using (region, sev, ref) join population using (region) group by d.region, slot, rank)) where r = 1)"""

SQL |= {
    "county_months": MONTHS + f""", {union('hu', "(select * from n where category = 'signup')", 'region, ref')}, hc as (select region, ref, greatest(s, {SINCE_US}) as s, least(e, {NOW_US}) as e from hu where s < {NOW_US} and e > {SINCE_US}),
{slices('hs', 'hc', 'month')}, hm as (select region, slot, count(distinct ref) as health_n from hs group by all), hn as (select region, count(distinct ref) as health_now from hu where s <= {NOW_US} and {NOW_US} <= e group by region), {_GRID},
q as (select grid.region, grid.slot, grid.population, {_COUNTS}, coalesce(person_us, 0) as person_us, coalesce(health_n, 0) as health_n, coalesce(health_now, 0) as health_now,
    greatest(least(epoch_us(grid.slot + interval 1 month), {NOW_US}) - greatest(epoch_us(grid.slot), {SINCE_US}), 1000000) as period
    from grid left join t on t.region = grid.region and t.slot = grid.slot left join hm on hm.region = grid.region and hm.slot = grid.slot left join hn on hn.region = grid.region),
r as (select *, 100 * (1 - person_us::double / (population::double * period)) as raw from q)
select region, strftime(slot, '%Y-%m') as month, {', '.join(f'n_{s}' for s in severity.SEVERITIES)}, cast(round_even(person_us / 3.6e9::double, 0) as bigint) as person_h, cast(round_even(period / 3.6e9::double, 0) as bigint) as period_h,
round_even(greatest(raw, 0), 3) as availability, case when raw >= 99.9 then 'A' when raw >= 99.75 then 'B' when raw >= 99.45 then 'C' when raw >= 99.0 then 'D' else 'F' end as grade, health_n, health_now from r""",
    "county_days": f"""with {N}, {AREAS}, {FOOT}, {PEOPLE}, {POPULATION}, {EVENTS}, {slices('dx', 'ev', 'day')}, {_DAYS},
g as (select region, unnest(generate_series(date_trunc('month', make_timestamp({SINCE_US})), cast(last_day(make_timestamp({NOW_US})) as timestamp), interval 1 day)) as slot from population),
j as (select g.region, g.slot, epoch_us(g.slot + interval 1 day) <= {SINCE_US} as early, cast(g.slot as date) <= cast(make_timestamp({NOW_US}) as date) as come, coalesce(sev, '') as sev, coalesce(pct, 0.0) as pct from g left join day_of d on d.region = g.region and d.slot = g.slot)
select region, strftime(slot, '%Y-%m-%d') as day, case when early then 'nd' else sev end as sev, case when early then 0.0 else pct end as pct, not early and come as elapsed, not early and come and sev = '' as clear from j""",
    "event_records": f"""with {N}, {AREAS}, {FOOT}, {union('u', 'n', 'region, ref')}, w as (select region, ref, sum(e - s)::double / 3.6e9::double as h, (max(e) - min(s))::double / 3.6e9::double as span from u group by all),
p as (select region, ref, cast(sum(pop) as bigint) as people from (select distinct region, ref, area, pop from foot) group by all),
m as (select region, ref, count(*) as pins, count(*) filter (value > 90) as confirmed, count(*) filter (value > 60 and not value > 90) as scheduled, bool_or(id % 5 = 0) as open,
    (['outage', 'quality', 'degraded', 'maintenance'])[min(list_position(['outage', 'quality', 'degraded', 'maintenance'], sev))] as sev from n group by all),
k as (select *, open or confirmed > 0 or scheduled > 0 as known from m join w using (region, ref) left join p using (region, ref))
select region, ref, sev, pins, confirmed, scheduled, open, nullif(people, 0) as people, case when known then round_even(h, 1) end as hours, case when known and span - h > 0.1::double then round_even(span, 1) end as span_h from k""",
    "area_histories": f"""with {N}, {AREAS}, r as (select n.id, ar.area, row_number() over (partition by n.id order by ar.pop desc, ar.area) as r from n join ar on ar.region = n.region and n.id % 10 = ar.area % 10),
h as (select distinct region, ref, coalesce(cast(r.area as varchar), 'unplaced') as area from n left join r on r.id = n.id and r.r = 1), c as (select region, ref, count(*) as k from h group by all), m as (select region, ref, min(s) as start from n group by all)
select region, ref, start, area, case when k > 1 then k end as areas, row_number() over (partition by region, area order by start desc, ref desc) as place from h join c using (region, ref) join m using (region, ref)""",
    "event_overlap": f"""with {N}, {AREAS}, {FOOT}, {POPULATION}, o as (select region, ref, s, e from n where sev = 'outage'), {union('ou', 'o', 'region, ref')}, f as (select distinct region, ref, area, pop from foot where sev = 'outage'),
w as (select region, ref, least(sum(pop), coalesce(any_value(population), sum(pop))) as people from f left join population using (region) group by all), pj as (select ou.*, people from ou join w using (region, ref)), {slices('px', 'pj', 'month')},
sj as (select region, area, pop, s, e from ou join f using (region, ref)), {union('su', 'sj', 'region, area, pop')}, {slices('sx', 'su', 'month')},
p as (select slot, sum(us * people) as published from px group by slot), q as (select slot, sum(us * pop) as exact from sx group by slot), b as (select strftime(slot, '%Y-%m') as month, coalesce(published, 0) as published, coalesce(exact, 0) as exact from p full outer join q using (slot))
select coalesce(month, 'TOTAL') as month, cast(sum(published) as bigint) as published, cast(sum(exact) as bigint) as exact, round_even(100.0::double * (sum(published) - sum(exact))::double / nullif(sum(published), 0)::double, 3) as twice_pct from b group by rollup (month)""",
    "consequential_review": SQL["consequential_events"].replace("with n as", "with n as", 1).rsplit("select e.region", 1)[0] + f""", d as (select region, sev, ref, min(id) as case_id, repeat('x', cast(max(id % 7) as int)) as description from n group by all)
select e.region, e.sev, e.ref, case when e.sev = 'degraded' then 'downgraded' else 'charged' end as effect, cast(round_even(coalesce(h, 0), 0) as bigint) as person_h, case_id, description from e left join h using (region, sev, ref) join d using (region, sev, ref)
where e.sev = 'degraded' or (e.sev = 'outage' and e.ref like '%5-error')""",
    "mixed_events": f"with {N} select region, ref, count(*) as pins, count(*) filter (id % 3 <> 1) as expanded from n group by all having count(*) filter (id % 3 <> 1) between 1 and count(*) - 1",
    "unquotable_windows": """with o as (select o_orderkey as id, o_orderkey as k, array_to_string(list_filter([case when o_orderkey % 4 > 1 then 'window_open' end, case when o_orderkey % 5 = 0 then 'window_close' end, case when o_orderkey % 2 = 1 and o_orderkey % 3 = 2 then 'window_first' end], lambda x: x is not null), ',') as missing,
o_orderkey % 2 = 1 and o_orderkey % 3 < 2 as inert from orders where o_orderkey % 11 <> 0 and o_orderkey % 13 <> 0) select id, missing, inert from o where missing <> '' or inert""",
    "pressure_backfill": "select o_orderkey, case o_orderkey % 3 when 0 then case when o_orderkey % 4 in (0, 2) then 1 else 0 end when 1 then 1 end as reduced_pressure from orders",
    "replayed_round": """with o as (select o_orderkey as k, o_orderkey % 7 = 2 as wrong from orders where o_orderkey % 7 > 1), t as (select k, case when wrong and k % 4 = 0 then 'completion_update' when k % 2 = 0 then 'not_found' else 'completion_update' end as true_source from o),
v as (select true_source, case when k % 5 = 0 then 'abstain' when k % 10 = 2 then 'incorrect' when k % 5 = 1 then 'abstain' when true_source = 'completion_update' then 'correct' else 'incorrect' end as v from t),
g as (select coalesce(true_source, 'TOTAL') as true_source, count(*) as n, count(*) filter (v = 'correct') as correct, count(*) filter (v = 'incorrect') as incorrect, count(*) filter (v = 'abstain') as abstained from v group by rollup (true_source))
select *, round_even(100 * correct::double / nullif(correct + incorrect, 0), 2) as accuracy from g""",
    "draw_round": """with f as (select min(doc_id) as doc_id, text from documents where doc_id not in (select doc_id from labels) group by text), r as (select doc_id, lang, row_number() over (partition by lang order by md5('3:' || doc_id), doc_id) as pick from documents join f using (doc_id))
select doc_id, lang, pick from r where pick <= case lang when 'en' then 30 else 10 end""",
    "window_labels": """with o as (select o_orderkey, cast(o_orderdate as date) as day, cast(cast(o_orderdate as date) as timestamp) + interval 23 hour as lo from orders), d as (select *, unnest([day, cast(day + 1 as date)]) as d0, unnest([0, 1]) as i from o),
w as (select o_orderkey, i, greatest(lo, timezone('UTC', timezone('Europe/Dublin', cast(d0 as timestamp) + interval 22 hour))) as s, timezone('UTC', timezone('Europe/Dublin', cast(d0 as timestamp) + interval 31 hour)) as e from d),
l as (select o_orderkey, i, timezone('Europe/Dublin', timezone('UTC', s)) as s, timezone('Europe/Dublin', timezone('UTC', e)) as e from w)
select o_orderkey, strftime(max(s) filter (i = 1), '%H:%M') || '-' || strftime(max(e) filter (i = 0), '%H:%M') || ' from ' || strftime(max(s) filter (i = 0), '%Y-%m-%d') as label from l group by o_orderkey""",
    "loaded_cases": "select o_orderkey as id, 'Mayo' as county, strftime(o_orderdate, '%Y-%m-%d') as start_date, case when o_orderkey % 2 = 0 then o_totalprice end as span, case when o_orderkey % 2 = 0 then 'completion_update' end as end_source from orders where o_orderkey % 5 <> 0 and o_orderkey % 7 <> 0",
} | round_trips.SQL | streams.sql(N, union, SQL["upsert_state"], VERSIONS, ISSUES)
SQL |= drivers.sql(N, AREAS, FOOT, union, slices, SQL["unquotable_windows"], severity.SEVERITIES, SINCE_US, NOW_US)


def _resolved(where: str) -> str:
    """The resolver's SQL over some of the events."""
    return SQL["resolved_notices"].replace("as county from events)", f"as county from events where {where})")


_LOG = "notices imputed accruing refused expanded not_inferred not_inferred_open payload_documents payload_bytes".split()
_COLUMNS = ", ".join(f"v{i}" for i in range(len(_LOG)))
_FIGURES = """select count(*), count(*) filter (imputed), count(*) filter (outcome = 'accrues'), 0, 0, count(*) filter (id % 6 >= 4), count(*) filter (id % 6 >= 4 and id % 4 = 0)"""
_BYTES = """(select count(*) from supplier where {0}), (select sum(strlen('{{"s_name":"' || s_name || '"}}')) from supplier where {0})"""
SQL |= {
    "whitelisted_notices": _resolved("user_id % 25 in (select n_nationkey from nation where n_regionkey <> 3)"),
    "build_changes": f"""with a({_COLUMNS}) as ({_FIGURES}, {_BYTES.format('true')} from ({_resolved('true')})), b({_COLUMNS}) as ({_FIGURES}, {_BYTES.format('s_suppkey % 3 <> 0')} from ({_resolved(f'epoch_us(ts) < {EARLIER_US}')})),
v as (select unnest({_LOG}) as figure, unnest([{', '.join(f'a.v{i}' for i in range(9))}]) as now, unnest([{', '.join(f'b.v{i}' for i in range(9))}]) as before from a, b)
select figure, cast(before as bigint) as before, cast(now as bigint) as now, cast(now - before as bigint) as change from v""",
}
