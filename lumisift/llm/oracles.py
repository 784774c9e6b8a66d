"""Plain SQL for the queries that SQL can express; DuckDB runs it on the same tables."""

from __future__ import annotations

from . import ranking

_KEY = "lower(regexp_replace(coalesce({0}, ''), '[^\\p{{L}}\\p{{N}}]', '', 'g'))"


def _key(x: str) -> str:
    return _KEY.format(x)


def _folder(x: str) -> str:
    path = f"replace({x}, '\\', '/')"
    return f"case when {path} like '%/%' then split_part({path}, '/', 1) end"


def _latest_value(table: str, value: str, name: str) -> str:
    return f"select frame_id, {name} from (select frame_id, {name}, row_number() over (partition by frame_id order by reported_at desc, seq desc) rn from (select *, {value} as {name} from {table}) where {name} is not null) where rn = 1"


def _num(c: str) -> str:
    return f"case when not isnan({c}) then {c} end"


_SCORE = f"case when {_num('lora_candidate_score')} between 0 and 110 then lora_candidate_score end"
_SIM = "case when isnan(identity_similarity_mean) then null when abs(identity_similarity_mean) <= 1 then identity_similarity_mean when abs(identity_similarity_mean) <= 100 then round(identity_similarity_mean / 100, 4) end"
_BRIGHT = "case when isnan(face_brightness_mean) then null when face_brightness_mean > 0 and face_brightness_mean <= 1 then round(face_brightness_mean * 255, 1) when face_brightness_mean between 0 and 255 then face_brightness_mean end"
_DIM = "case when face_min_dimension between 1 and source_short_edge then face_min_dimension end"

_SCENES = f"""scenes as (
  select frame_id, case when {_key('scene_group')} = '' then {_key(_folder('filename'))} else {_key('scene_group')} end as scene
  from (select *, row_number() over (partition by frame_id order by reported_at desc, seq desc) rn from step4_dataset_report) where rn = 1)"""

_CAPPED = f"""with {_SCENES}, scored as ({_latest_value('step7_dataset_report', _SCORE, 'score')}),
named as (select scored.frame_id, score, scene from scored join scenes using (frame_id)),
ranked as (select *, row_number() over (partition by scene order by score desc, frame_id) rn,
  case when scene like '%reference%' or scene like '%identity%' then 15 else 8 end as most from named)"""

_FOUR = f"""with a as ({_latest_value('step7_dataset_report', _SCORE, 'score')}),
b as ({_latest_value('step6_dataset_report', _SIM, 'sim')}),
c as ({_latest_value('step3_dataset_report', _BRIGHT, 'bright')}),
e as ({_latest_value('step3_dataset_report', _DIM, 'dim')}),
f as (select frame_id, score, sim, -round(abs(bright - 140.0), 1) as br, dim from a join b using (frame_id) join c using (frame_id) join e using (frame_id)),
r as (select frame_id, count(*) over () as n, rank() over (order by score desc) - 1 as score_better, rank() over (order by sim desc) - 1 as similarity_better,
  rank() over (order by br desc) - 1 as brightness_better, rank() over (order by dim desc) - 1 as dim_better from f)"""

_QUALITY = f"case when {_num('face_quality_score')} between -30 and 2270 then face_quality_score end"

_LINKS = """names as (select lower(trim(split_part(replace(filename, '\\', '/'), '/', -1))) as name, min(frame_id) as dst from step5_dataset_report group by 1),
links as (select distinct s.frame_id as src, names.dst from step5_dataset_report s join names on names.name = lower(trim(split_part(replace(group_best, '\\', '/'), '/', -1)))
  where phash_distance_to_group_best <= 14 and angle_distance_to_group_best <= 12.0 and not isnan(angle_distance_to_group_best) and s.frame_id <> names.dst),
both_ways as (select src, dst from links union select dst, src from links),
reach(a, b) as (select distinct src, src from both_ways union select reach.a, both_ways.dst from reach join both_ways on reach.b = both_ways.src)"""

_POSED = f"""with {_SCENES}, posed as (
  select frame_id, {_key('pose_cluster_key')} as cell, pose_yaw as y, pose_pitch as p from (
    select *, row_number() over (partition by frame_id order by reported_at desc, seq desc) rn from step4_dataset_report where {_key('pose_status')} = 'ok') where rn = 1),
f as (select posed.*, scene from posed join scenes using (frame_id) where y is not null and p is not null and not isnan(y) and not isnan(p))"""

_CELL = f"case when {_key('shot_type')} = '' or {_key('pose_bucket')} = '' then {_key('quota_cell')} else {_key('shot_type')} || {_key('pose_bucket')} end"
_CELLS = f"""with members as (select {_CELL} as category, count(*) as available from (
  select *, row_number() over (partition by frame_id order by reported_at desc, seq desc) rn from step7_dataset_report) where rn = 1 and {_key('quota_status')} <> '' group by 1),
cells as (select q.request_id, q.quota_cell, coalesce(available, 0) as available,
  coalesce(available, 0) < greatest(cast(min_count as double), round(target_share * sample_size, 9)) as unmet
  from quota_targets q left join members on category = {_key('q.shot_type')} || {_key('q.pose_bucket')})"""



def _poly(coefficients: tuple[float, ...], x: str) -> str:
    out = repr(coefficients[0])
    for c in coefficients[1:]:
        out = f"({out} * {x} + ({c!r}))"
    return out.replace("e-", "E-")


def _normal(p: str) -> str:
    """The same approximation of the normal quantile as in the operator."""
    t, q = f"sqrt(-2 * ln(least({p}, 1 - {p})))", f"({p} - 0.5::double)"
    outer = f"({_poly(ranking._C, t)} / ({_poly(ranking._D, t)} * {t} + 1))"
    inner = f"({_poly(ranking._A, f'({q} * {q})')} * {q} / ({_poly(ranking._B, f'({q} * {q})')} * ({q} * {q}) + 1))"
    return f"case when {p} < 0.02425::double then {outer} when {p} > 1 - 0.02425::double then -{outer} else {inner} end"


_WEIGHTS = {"score": 0.4, "similarity": 0.3, "brightness": 0.15, "dim": 0.15}
_PLACED = f"""{_FOUR}, e2 as (select *, count(*) over (partition by score) as e_score, count(*) over (partition by sim) as e_similarity, count(*) over (partition by br) as e_brightness, count(*) over (partition by dim) as e_dim from f),
pct as (select r.frame_id, {', '.join(f"((r.n - {c}_better - e_{c}) + e_{c} / 2::double) / r.n as {c}_pct" for c in _WEIGHTS)} from r join e2 using (frame_id)),
z as (select *, {', '.join(f"{_normal(f'{c}_pct')} as {c}_z" for c in _WEIGHTS)} from pct),
mean as (select *, round((0.0::double + {' + '.join(f"{c}_z * {w}::double" for c, w in _WEIGHTS.items())}) / {sum(_WEIGHTS.values())!r}::double, 9) as combined from z)"""

# The largest-remainder allocation: the scale of the shares is found between the points at which a cell reaches its floor or its cap. Every share is above 0.
_ALLOCATED = f"""{_CELLS}, base as (
  select q.request_id, q.quota_cell, {_key('q.shot_type')} || {_key('q.pose_bucket')} as category, coalesce(m.available, 0)::double as high, least(greatest(min_count, 0), coalesce(m.available, 0))::double as low,
    target_share / max(target_share) over (partition by request_id) as share, sample_size, greatest(cast(min_count as double), round(target_share * sample_size, 9)) as needed
  from quota_targets q left join members m on m.category = {_key('q.shot_type')} || {_key('q.pose_bucket')}),
goals as (select request_id, least(max(sample_size), sum(high))::double as goal, sum(low) as lows from base group by 1),
points as (select distinct request_id, unnest([0.0::double, low / share, high / share]) as x from base),
sums as (select p.request_id, x, sum(least(greatest(x * share, low), high)) as filled, sum(case when low / share <= x and x < high / share then share else 0 end) as slope from points p join base using (request_id) group by 1, 2),
scales as (select s.request_id, goal, lows, max_by(x + case when slope > 0 then (goal - filled) / slope else 0 end, x) as scale from sums s join goals using (request_id) where filled <= goal + 1e-9 or x = 0 group by 1, 2, 3),
exacts as (select b.*, goal, lows, case when lows >= goal then low else least(greatest(scale * share, low), high) end as exact from base b join scales using (request_id)),
whole as (select *, floor(exact + 1e-9) as q0 from exacts),
ordered as (select *, row_number() over (partition by request_id, q0 < high order by round(exact - q0, 9) desc, category) as place, sum(q0) over (partition by request_id) as given from whole),
quotas as (select request_id, quota_cell, category, high::bigint as available, needed, (q0 + case when lows < goal and q0 < high and place <= goal - given then 1 else 0 end)::bigint as quota from ordered)"""

_SIZES = f"""sizes as (select {_key('source')} as k, sum(ceil(length(coalesce(text, '')) / 4::double))::bigint as have from documents group by 1),
mix as (select mix_id, source, target_weight, greatest(coalesce(max_repeats, 0), 0) as most, total_tokens::double as total, coalesce(have, 0) as have, coalesce(have, 0)::double * greatest(coalesce(max_repeats, 0), 0) as cap
  from mix_targets left join sizes on k = {_key('source')})"""

# What short sources cannot give goes to the others in proportion to their weights: exponent 0, which holds where no other source is then asked for more than it has.
_BUDGETS = f"""with {_SIZES}, want as (select *, target_weight * total as want, least(target_weight * total, cap) as base from mix),
spare as (select *, sum(want) over w - sum(base) over w as missing, sum(case when cap > base then target_weight else 0 end) over w as open_weight from want window w as (partition by mix_id))
select mix_id, source, have::bigint as available_tokens, floor(round(want, 6) + 0.5)::bigint as target, floor(base + case when cap > base then missing * target_weight / open_weight else 0 end + 0.5)::bigint as budget, cap < round(want, 6) as short from spare"""

# Sixty bisections of the exponent, as in the operator.
_TEMPERATURE = f"""with recursive {_SIZES}, shares as (select *, have::double / sum(have) over (partition by mix_id) as share, count(*) over (partition by mix_id) as many from mix),
rules as (select unnest(['limit', 'entropy']) as rule),
tries(mix_id, rule, low, high, x, i) as (
  select distinct mix_id, rule, 0.0::double, 1.0::double, 0.0::double, 0 from shares, rules
  union all
  select mix_id, rule, l, h, (l + h) / 2, i + 1 from (
    select t.mix_id, t.rule, t.i, case when fits or t.i = 0 then t.low else t.x end as l, case when t.i = 0 and fits then 0.0 when t.i = 0 then 1.0 when fits then t.x else t.high end as h
    from tries t, lateral (select case when t.rule = 'limit' then bool_and(w * total <= cap * (1 + 1e-12::double)) else sum(case when w > 0 then -w * ln(w) else 0 end) <= ln(max(many)::double) * 0.9::double end as fits
      from (select total, cap, many, case when share > 0 then share ** t.x else 0 end / sum(case when share > 0 then share ** t.x else 0 end) over () as w from shares s where s.mix_id = t.mix_id)) y)
  where i < 61)
select s.mix_id, source, rule, floor(high * 1e6 + 0.5)::bigint as exponent_e6, floor(case when share > 0 then share ** high else 0 end / sum(case when share > 0 then share ** high else 0 end) over (partition by s.mix_id, rule) * 1e6 + 0.5)::bigint as weight_e6
from shares s join tries t using (mix_id) where i = 61"""


def oracle_sql() -> dict[str, str]:
    """SQL by query. Sizes in tokens cannot be had in SQL: p8_found rests on every usual tokenizer giving the same rows, a token per four characters included; p8_budgets, p8_temperature, p7_pieces and p7_audit use that size rule on both sides."""
    return {
        "p2_ranking": f"{_PLACED} select frame_id, score_pct, similarity_pct, brightness_pct, dim_pct, combined, rank() over (order by combined desc) as rank from mean",
        "p3_origin": f"""with g as (select *, lower(trim(duplicate_group)) as grp, {_QUALITY} as q from step5_dataset_report where trim(duplicate_group) <> ''),
            v as (select run_id, grp, frame_id, q, row_number() over (partition by run_id, grp, frame_id order by reported_at desc, seq desc) rn from g where q is not null),
            m as (select run_id, grp, count(distinct frame_id) as frames from g group by 1, 2 having count(distinct frame_id) > 1),
            best as (select run_id, grp, frame_id, q, frames, row_number() over (partition by run_id, grp order by q desc, frame_id) place from v join m using (run_id, grp) where rn = 1),
            own as (select *, row_number() over (partition by run_id, grp, frame_id order by reported_at desc, seq desc) rn from g)
            select run_id, grp as duplicate_group, frame_id, best.q as face_quality_score, frames, seq, filename, temporal_index from best join own using (run_id, grp, frame_id) where place = 1 and rn = 1""",
        "p5_kinds": f"""{_POSED}, near as (select f.frame_id, exists (select 1 from f g where g.scene = f.scene and g.cell = f.cell and g.frame_id <> f.frame_id and (g.y - f.y) * (g.y - f.y) + (g.p - f.p) * (g.p - f.p) <= 144.000000001) as met from f)
            select scene, cell as pose_cell, count(*) as frames, count(*) filter (not met) as lone, true as shown from f join near using (frame_id) group by 1, 2""",
        "p6_report": f"{_ALLOCATED} select request_id, quota_cell, available, needed, quota, greatest(needed - available, 0) as shortfall, quota < needed and available < needed as unmet from quotas",
        "p6_drawn": f"{_ALLOCATED} select request_id, category, quota as drawn, quota as frames from quotas where quota > 0",
        "p7_pieces": f"select doc_id, ceil(n / 2048.0)::bigint as pieces, n as units from (select doc_id, ceil(length(coalesce(text, '')) / 4::double)::bigint as n from documents)",
        "p7_audit": "select sum(ceil(length(coalesce(text, '')) / 4::double))::bigint as units, true as fits, true as dense from documents",
        "p8_found": f"with {_SIZES} select mix_id, source from mix where cap < round(target_weight * total, 6)",
        "p8_budgets": _BUDGETS,
        "p8_temperature": _TEMPERATURE,
        "p1_found": f"{_CAPPED} select frame_id from ranked where rn > most",
        "p1_capped": f"{_CAPPED} select scene, frame_id, score from ranked where rn <= most",
        "p2_found": f"{_FOUR} select frame_id from r where score_better * 10 < n and similarity_better * 10 < n and brightness_better * 10 < n and dim_better * 10 < n",
        "p2_percentiles": f"{_FOUR} select frame_id, score_better, similarity_better, brightness_better, dim_better, n from r",
        "p3_found": f"""with g as (select *, lower(trim(duplicate_group)) as grp, {_QUALITY} as q from step5_dataset_report where trim(duplicate_group) <> ''),
            v as (select run_id, grp, frame_id, q, row_number() over (partition by run_id, grp, frame_id order by reported_at desc, seq desc) rn from g where q is not null),
            m as (select run_id, grp from g group by 1, 2 having count(distinct frame_id) > 1)
            select run_id, grp as duplicate_group, frame_id from (
              select run_id, grp, frame_id, row_number() over (partition by run_id, grp order by q desc, frame_id) place from v join m using (run_id, grp) where rn = 1) where place = 1""",
        "p4_found": f"with recursive {_LINKS} select a as frame_id, min(b) as group_id from reach group by 1",
        "p4_sizes": f"with recursive {_LINKS}, g as (select a, min(b) as group_id from reach group by 1) select group_id, count(*) as frames from g group by 1",
        "p1_share_capped": f"""{_CAPPED}, sizes as (select scene, count(*) as n from named group by 1), tries as (select unnest(range(1, (select max(n) + 1 from sizes))) as c),
            cap as (select coalesce(max(c), (select min(n) from sizes)) as c from tries where c <= 0.05::double * (select sum(least(n, tries.c)) from sizes) + 1e-9)
            select scene, n as frames, least(n, (select c from cap)) as kept_frames from sizes""",
        "p5_found": f"{_POSED} select frame_id from f where not exists (select 1 from f g where g.scene = f.scene and g.cell = f.cell and g.frame_id <> f.frame_id and (g.y - f.y) * (g.y - f.y) + (g.p - f.p) * (g.p - f.p) <= 144.000000001)",
        "p6_found": f"{_CELLS} select request_id, quota_cell from cells where unmet",
        "p6_cells": f"{_CELLS} select request_id, quota_cell, available, unmet from cells",
    }
