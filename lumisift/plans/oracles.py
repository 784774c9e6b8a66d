"""Plain SQL for the queries of :mod:`.catalog` that SQL can express; DuckDB runs it on the same tables."""

from __future__ import annotations

from ..functions import captions
from ..sources.sinks import guide_rest
from ..params import BASE_THRESHOLDS, POSE_MAX, POSE_MIN, POSE_MODIFIERS, SHOT_MAX, SHOT_MIN


def _n(c: str) -> str:
    """A number with NaN as null."""
    return f"(case when not isnan({c}::double) then {c}::double end)"


def _path(c: str) -> str:
    return f"trim(replace({c}, '\\', '/'))"


def _base(c: str) -> str:
    return f"trim(split_part({_path(c)}, '/', -1))"


def _stem(c: str) -> str:
    return f"regexp_replace({_base(c)}, '^(.+)\\.[^.]*$', '\\1')"


def _scene(c: str) -> str:
    tokens = f"string_split({_stem(c)}, '_')"
    return f"case when {_path(c)} like '%/%' then split_part({_path(c)}, '/', 1) when len({tokens}) >= 2 then array_to_string({tokens}[1:2], '_') else {_stem(c)} end"


def _index(c: str) -> str:
    return f"coalesce(try_cast(list_filter(string_split({_stem(c)}, '_'), lambda t: regexp_full_match(t, '[0-9]+'))[-1] as int), 0)"


def _map(c: str, table: dict, default: object, kind: str = "") -> str:
    value = (lambda v: f"'{v}'") if isinstance(default, str) else (lambda v: f"{v}::double")
    return "case " + " ".join(f"when {c} = '{k}' then {value(v)}" for k, v in table.items()) + f" else {value(default)} end"


def _e(x: str, digits: int) -> str:
    return f"cast(floor(({x}) * {10**digits}::double + 0.5) as bigint)"


def _share(n: str, total: str) -> str:
    return f"cast(floor({n} * 10000 / greatest({total}, 1)::double + 0.5) as bigint)"


_FULL = "coalesce(shot_type, 'UPPER_BODY') = 'FULL_BODY'"
_CLOSE = "coalesce(shot_type, 'UPPER_BODY') = 'CLOSE_UP'"
_REASONS = f"""list_filter([
  case when face_gate_status = 'error' then 'analysis_error' end,
  case when face_gate_status <> 'error' and not coalesce(face_detected, false) then 'no_face' end,
  case when not coalesce(face_gate_status <> 'error' and not coalesce(face_detected, false), false) and coalesce(face_count, -1) <> 1 then 'multiple_faces' end,
  case when coalesce({_n('laplacian_score')}, 0) < 25 then 'global_blurry' end,
  case when face_detected and {_FULL} and source_short_edge < 720 then 'low_resolution_source' end,
  case when face_detected and coalesce(face_min_dimension, 0) < (case when {_FULL} then 80 when {_CLOSE} then 140 else 110 end) then 'face_too_small' end,
  case when face_detected and (not coalesce(facemesh_detected, false) or coalesce({_n('face_visibility_score')}, -1) < 70) then 'low_visibility' end,
  case when face_detected and {_n('face_central_gradient')} > 65 then 'hair_covered_face' end,
  case when face_detected and not {_FULL} and not coalesce(eye_presence_valid, false) then 'one_eye_occluded' end,
  case when face_detected and coalesce({_n('face_brightness_mean')}, 0) < 95 then 'face_underexposed' end,
  case when face_detected and coalesce({_n('face_brightness_mean')}, 0) >= 95 and coalesce({_n('face_brightness_mean')}, 0) < 105 and coalesce({_n('face_to_global_brightness_ratio')}, 1) < 0.65 then 'face_backlit_underexposed' end,
  case when face_detected and coalesce(beauty_filter_detected, false) then 'beauty_filter_detected' end,
  case when face_detected and ((not {_FULL} and coalesce({_n('eye_sharpness')}, 0) < 1.60) or coalesce({_n('face_laplacian_score')}, 0) < 50) then 'face_blurry' end
], lambda r: r is not null)"""
_HAS = "list_has_any(r, [{0}])".format
_GATED = f"""with g as (select seq, {_REASONS} as r from step3_dataset_report),
c as (select seq, r, case when len(r) = 0 then 'ELIGIBLE' when {_HAS("'analysis_error'")} then 'REVIEW_UNKNOWN' when {_HAS("'no_face'")} then 'REJECT_NO_FACE'
  when {_HAS("'multiple_faces'")} then 'REJECT_MULTIPLE_FACE' when {_HAS("'low_resolution_source'")} then 'REJECT_LOW_RES' when {_HAS("'beauty_filter_detected'")} then 'REJECT_BEAUTY_FILTER'
  when {_HAS("'low_visibility', 'hair_covered_face', 'one_eye_occluded', 'face_underexposed', 'face_backlit_underexposed'")} then 'REJECT_OCCLUSION'
  when {_HAS("'face_blurry', 'global_blurry'")} then 'REJECT_BLUR' when {_HAS("'face_too_small'")} then 'REJECT_SMALL_FACE' else 'REVIEW_UNKNOWN' end as cat from g)"""

_VIS_LOW = f"least({_n('eye_ratio_left')}, {_n('eye_ratio_right')})"
_VIS_HIGH = f"greatest({_n('eye_ratio_left')}, {_n('eye_ratio_right')})"
_BOTH_EYES = f"{_n('eye_ratio_left')} is not null and {_n('eye_ratio_right')} is not null"
_VIS = f"""with s as (select *, (seq % 50 + 50) / 100::double as conf, seq % 5 as outside,
  face_bbox_x <= 1 or face_bbox_y <= 1 or face_bbox_x + face_bbox_width >= width - 1 or face_bbox_y + face_bbox_height >= height - 1 as edge,
  case when not coalesce(facemesh_detected, false) then 'landmarks_not_found' when not coalesce(face_bbox_width > 0 and face_bbox_height > 0, false) then 'empty_face_box' end as failed from step3_dataset_report),
h as (select seq, failed, conf < 0.60 as a, conf >= 0.60 and conf < 0.75 as b, outside > 0 as c, least(outside * 15, 45) as cm, ({_VIS_LOW} < 0.07 and {_VIS_HIGH} > 0.16) as e,
  {_n('eye_brightness_ratio')} > 0.35 as f, {_n('eye_texture_ratio')} < 0.30 as g, edge as i from s),
v as (select seq, failed, greatest(0, least(100, 100 - (case when a then 25 else 0 end) - (case when b then 12 else 0 end) - (case when c then cm else 0 end) - (case when e then 35 else 0 end) - (case when f then 25 else 0 end) - (case when g then 15 else 0 end) - (case when i then 20 else 0 end))) as sc,
  array_to_string(list_filter([case when a then 'low_detection_confidence' end, case when b then 'moderate_detection_confidence' end, case when c then 'implausible_face_landmarks' end, case when e then 'asymmetric_eye_visibility' end,
    case when f then 'asymmetric_eye_brightness' end, case when g then 'asymmetric_eye_detail' end, case when i then 'face_touches_image_edge' end], lambda x: x is not null), ';') as sg from h),
w as (select seq, (case when failed is null then sc else 0 end)::double as score, case when failed is not null then 'unknown' when sc >= 90 then 'none' when sc >= 80 then 'mild' when sc >= 70 then 'moderate' else 'heavy' end as level, coalesce(failed, sg) as signals from v)"""

_ONE_FACE = "face_count = 1 and face_gate_status = 'ok'"


def _mid(table: str, value: str, where: str) -> str:
    return f"select seq, case when {_n(value)} is null then null when count({_n(value)}) over () = 1 then 100 else ((rank() over (order by {_n(value)} nulls last) - 1) + (count(*) over (partition by {_n(value)}) - 1) / 2::double) / (count({_n(value)}) over () - 1) * 100 end as pct from {table} where {where}"


def _dense(table: str, value: str, where: str) -> str:
    return f"select seq, case when {_n(value)} is null then null when (select count(distinct {_n(value)}) from {table} where {where}) = 1 then 100 else floor((dense_rank() over (order by {_n(value)} nulls last) - 1) * 100::double / ((select count(distinct {_n(value)}) from {table} where {where}) - 1) * 100 + 0.5) / 100 end as pct from {table} where {where}"


_OK = "status = 'ok'"
_OK2 = "status = 'ok' and not isnan(laplacian_score) and not isnan(tenengrad_score)"
_FRAMES = """with videos as (select distinct video, duration_sec as d from step1_extract_report where duration_sec > 0 and not isnan(duration_sec)),
span as (select video, case when d - 0.5::double > 0.5 then 0.5::double else d * 0.05::double end as s, case when d - 0.5::double > 0.5 then d - 0.5::double else d * (1 - 0.05::double) end as e from videos),
plan as (select video, i + 1 as idx, s + i * ((e - s) / 49) as t, printf('%s_%03d.png', regexp_replace(video, '^(.+)\\.[^.]*$', '\\1'), i + 1) as frame from span, range(0, 50) r(i))"""

_CAND = f"""with cand as (select seq, width, height, coalesce(shot_type, 'UPPER_BODY') as shot_type, coalesce(pose_bucket, 'FRONT') as pose_bucket, filename,
  printf('%02d_score%05.1f_%s_%s_%s', candidate_rank, floor(lora_candidate_score * 10 + 0.5) / 10, coalesce(shot_type, 'UPPER_BODY'), coalesce(pose_bucket, 'FRONT'), {_base('filename')}) as name
  from step7_dataset_report where candidate_selected and candidate_rank is not null and not isnan(lora_candidate_score))"""


def _in_name(values: tuple[str, ...], default: str) -> str:
    return "case " + " ".join(f"when contains(upper({_stem('name')}), '{v}') then '{v}'" for v in values) + f" else '{default}' end"


_SHOT_NAME = _in_name(("CLOSE_UP", "FULL_BODY", "UPPER_BODY"), "OTHER")
_POSE_NAME = _in_name(("FRONT", "LEFT_3Q", "RIGHT_3Q", "LEFT_PROFILE", "RIGHT_PROFILE", "LOOKING_DOWN", "LOOKING_UP"), "OTHER")

_THRESHOLD = f"greatest({_map('shot_type', BASE_THRESHOLDS, 0.58)} + ({_map('pose_bucket', POSE_MODIFIERS, -0.04)} - case when abs(coalesce({_n('pose_yaw')}, 0)) > 50 then 0.03::double else 0::double end), 0.45::double)"
_IDENT = f"with t as (select seq, {_n('identity_similarity_mean')} as sim, {_THRESHOLD} as threshold from step6_dataset_report)"
_CLASS = "case when sim >= threshold then 'PASSED' when sim >= threshold - 0.05::double then 'REVIEW' when sim is not null then 'REJECT_IDENTITY' end"

_BR, _LIGHT = _n("face_brightness_mean"), f"coalesce({_n('face_brightness_mean')}, 120)"
_QUALITY = f"""(case when eye_presence_valid then 1000::double else 0::double end) + coalesce(case when {_n('eye_sharpness')} is not null then least({_n('eye_sharpness')}, 10) * 100 end, 0) + coalesce(case when {_n('face_laplacian_score')} is not null then least({_n('face_laplacian_score')}, 300) * 0.5::double end, 0)
  + coalesce(case when {_n('mouth_sharpness')} is not null then least({_n('mouth_sharpness')}, 5) * 20 end, 0) + (case when {_BR} between 110 and 160 then 20 when {_BR} < 95 or {_BR} > 210 then -30 else 0 end)"""
_DIM = f"coalesce({_n('face_min_dimension')}, 100)"
_PARTS = {
    "ID": f"greatest(least((coalesce({_n('identity_similarity_mean')}, 0.55::double) - 0.5::double) / 0.35::double, 1), 0) * 35::double",
    "Sharp": f"least(coalesce({_n('eye_sharpness')}, 0) / 4, 1) * 18::double + least(coalesce({_n('mouth_sharpness')}, 0) / 2.5::double, 1) * 7::double",
    "Res": f"least({_DIM} / (case when coalesce(shot_type, 'UPPER_BODY') = 'CLOSE_UP' then 280::double when coalesce(shot_type, 'UPPER_BODY') = 'UPPER_BODY' then 180::double else 110::double end), 1) * 20::double",
    "Exp": f"(case when {_LIGHT} between 115 and 165 then 15::double when {_LIGHT} between 95 and 190 then 10::double else 4::double end) + (case when coalesce({_n('face_to_global_brightness_ratio')}, 1) >= 0.9::double then 5 when coalesce({_n('face_to_global_brightness_ratio')}, 1) >= 0.75::double then 3 else 0 end)",
    "Bonus": "(case when coalesce(pose_bucket, 'FRONT') like '%PROFILE%' then 10 when coalesce(pose_bucket, 'FRONT') like '%3Q%' then 3 when pose_bucket = 'LOOKING_DOWN' then 2 else 0 end)",
}


def _dups(angle: float, window: int, near: int, phash: int, strict: float) -> str:
    far = lambda h: f"coalesce(bit_count(xor(a.{h}, b.{h})), 99)"
    gap = "coalesce(sqrt((a.yaw - b.yaw) * (a.yaw - b.yaw) + (a.pitch - b.pitch) * (a.pitch - b.pitch)), 999)"
    return f"""with recursive f as (select seq, lower({_scene('filename')}) as scene, coalesce(shot_type, '') as shot, {_index('filename')} as t, {_n('pose_yaw')} as yaw, {_n('pose_pitch')} as pitch, global_hash as gh, face_hash as fh, filename, coalesce({_n('face_quality_score')}, 0) as quality
    from (select *, row_number() over (partition by frame_id order by reported_at desc, seq desc) rn from step5_dataset_report) where rn = 1 and (global_hash is not null or face_hash is not null)),
  e as (select a.seq as x, b.seq as y from f a join f b on a.scene = b.scene and a.shot = b.shot and a.seq <> b.seq
    where ({gap} <= {angle} and abs(a.t - b.t) <= {window} and ({far('gh')} <= {near} or {far('fh')} <= {near})) or ({gap} <= {strict} and ({far('gh')} <= {phash} or {far('fh')} <= {phash}))),
  reach(x, y) as (select seq, seq from f union select reach.x, e.y from reach join e on reach.y = e.x),
  comp as (select x as seq, min(y) as component from reach group by 1),
  links as (select seq, (select count(*) from e where e.x = f.seq) as links from f)"""


_CLUSTERS = f"""{_dups(12, 6, 14, 10, 8)},
  m as (select f.*, component, floor(quality * 10 + 0.5) / 10 as q1 from f join comp using (seq)),
  b as (select component, count(*) as group_size, min(seq) as first, arg_max(seq, (q1, -seq)) as best_seq from m group by 1),
  nb as (select *, row_number() over (order by first) as number from b),
  cl as (select m.seq, printf('cluster_%04d_%s', number, m.scene) as duplicate_group, group_size, w.filename as group_best,
    case when group_size = 1 then 'unique' when m.seq = best_seq then 'representative' else 'duplicate' end as duplicate_status,
    bit_count(xor(m.gh, w.gh))::int as phash_distance_to_group_best, {_e('coalesce(sqrt((m.yaw - w.yaw) * (m.yaw - w.yaw) + (m.pitch - w.pitch) * (m.pitch - w.pitch)), 0)', 4)} as angle_e4
    from m join nb using (component) join m w on w.seq = best_seq)"""

_REST = f"""with r as (select seq, filename, coalesce(shot_type = 'FULL_BODY' and (coalesce({_n('face_min_dimension')}, 200) < 190 or coalesce({_n('eye_sharpness')}, 2) < 2), false) as wanted,
  coalesce({_n('identity_similarity_mean')}, 0) as before, coalesce({_n('identity_similarity_max')}, 0) as after, (seq % 40) / 100::double + 0.6::double as fidelity from step7_dataset_report),
decided as (select *, case when not wanted then 'untouched_raw_camera' when after >= 0.6::double and after - before >= -0.08::double and fidelity >= 0.82::double then 'safely_restored' else 'rollback_to_original' end as restoration_status from r)"""


def _selection() -> str:
    """The three phases of the selection, row by row, with the counters as maps."""
    cap = "case when scene like '%reference%' or scene like '%identity%' then 15 else 8 end"
    table = lambda c, t, d: "case " + " ".join(f"when {c} = '{k}' then {v}" for k, v in t.items()) + f" else {d} end"
    counts = lambda c: f"coalesce((select map_from_entries(list(row({c}, n))) from (select {c}, count(*)::int as n from pool where profile group by 1)), map([]::varchar[], []::int[]))"
    more = lambda m, c: f"case when t then map_concat({m}, map([{c}], [coalesce({m}[{c}], 0) + 1])) else {m} end"
    state = f"{more('sc', 'scene')}, {more('sh', 'shot')}, {more('po', 'pose')}, n + t::int"
    two = f"not profile and not done and coalesce(sc[scene], 0) < cap and (coalesce(sh[shot], 0) < {table('shot', SHOT_MIN, 0)} or coalesce(po[pose], 0) < {table('pose', POSE_MIN, 0)})"
    three = f"not profile and n < 65 and not coalesce(took2, false) and coalesce(sc[scene], 0) < cap and coalesce(sh[shot], 0) < {table('shot', SHOT_MAX, 999)} and coalesce(po[pose], 0) < {table('pose', POSE_MAX, 999)}"
    return f"""with recursive scored as (select seq, lower({_scene('filename')}) as scene, coalesce(shot_type, 'UPPER_BODY') as shot, coalesce(pose_bucket, 'FRONT') as pose, {' + '.join(f'({v})' for v in _PARTS.values())} as score from step7_dataset_report where identity_passed),
    pool as (select *, floor(score * 100 + 0.5) / 100 as score2, pose like '%PROFILE%' as profile, {cap} as cap, row_number() over (order by floor(score * 100 + 0.5) / 100 desc, seq) as i from scored),
    p2(i, seq, took, sc, sh, po, n, done) as (
      select 0::bigint, null::bigint, false, {counts('scene')}, {counts('shot')}, {counts('pose')}, (select count(*)::int from pool where profile), false
      union all select i, seq, t, {state}, done or (t and n + 1 >= 65) from (select pool.*, p2.sc, p2.sh, p2.po, p2.n, p2.done, {two} as t from p2 join pool on pool.i = p2.i + 1)),
    took as (select pool.*, p2.took as took2 from pool join p2 using (seq)),
    p3(i, seq, took, sc, sh, po, n) as (
      select 0::bigint, null::bigint, false, sc, sh, po, n from (select * from p2 order by i desc limit 1)
      union all select i, seq, t, {state} from (select took.*, p3.sc, p3.sh, p3.po, p3.n, {three} as t from p3 join took on took.i = p3.i + 1)),
    phases as (select took.seq, shot, pose, score2, case when profile then 1 when took2 then 2 when p3.took then 3 end as phase from took join p3 using (seq)),
    ranks as (select seq, row_number() over (order by score2 desc, phase, seq) as candidate_rank from phases where phase is not null)
    select phases.seq, shot || '_' || pose as quota_cell, case phase when 1 then 'selected_profile_priority' when 2 then 'selected_quota_minimum' when 3 then 'selected_score_fill' else 'rejected_quota_exceeded' end as quota_status,
      phase is not null as candidate_selected, candidate_rank from phases left join ranks using (seq)"""


def _attributes(phrases: dict[str, list[str]]) -> list[str]:
    return [f"([{', '.join(repr(x) for x in phrases[a])}])[seq % {len(phrases[a])} + 1]" for a in captions.ATTRIBUTES]


def oracle_sql() -> dict[str, str]:
    from .catalog import PHRASES

    attrs = _attributes(PHRASES)
    caption = f"concat_ws(', ', concat_ws(' ', {_map('shot_type', captions.SHOT_PHRASES, captions.SHOT_DEFAULT)}, 'character'), '{captions.SUBJECT}', {_map('pose_bucket', captions.POSE_PHRASES, captions.POSE_DEFAULT)}, {', '.join(attrs)}, '{captions.CAPTION_END}')"
    tags = f"concat_ws(', ', 'character', '{captions.TAG_START}', replace(lower(shot_type), '_', ' '), replace(lower(pose_bucket), '_', ' '), {', '.join(attrs)}, '{captions.TAG_END}')"
    align = lambda x: f"greatest(floor(({x} + 8) / 16::double) * 16, 16)::int"
    folders = "['all_ranked', 'by_shot/' || shot_type, 'by_pose/' || pose_bucket]"
    stats = lambda v, lo, hi: f"count(*) as n, {_e(f'avg({v})', 3)} as mean_e3, {_e(f'stddev_pop({v})', 3)} as std_e3, {_e(f'var_pop({v})', 3)} as var_e3, {_e(f'avg({v} * {v})', 3)} as square_e3, {_e(f'avg(({v} < {lo})::int)', 3)} as low_e3, {_e(f'avg(({v} > {hi})::int)', 3)} as high_e3, {_e(f'quantile_cont({v}, 0.9) - quantile_cont({v}, 0.1)', 6)} as contrast_e6"
    two = lambda x: f"printf('%.2f', floor({x} * 100 + 0.5) / 100)"
    return {
        "gate_rows": f"{_GATED} select seq, array_to_string(r, ';') as reasons, len(r) = 0 as face_eligible, cat as face_gate_category from c",
        "gate_category_counts": f"{_GATED} select cat as face_gate_category, count(*) as n, {_share('count(*)', 'sum(count(*)) over ()')} as share_e4 from c group by 1",
        "gate_reasons_exploded": f"{_GATED} select reason, count(*) as n from (select unnest(r) as reason from g) group by 1",
        "gate_funnel": f"""{_GATED}, k as (select r, not {_HAS("'analysis_error'")} as a, not {_HAS("'no_face', 'multiple_faces'")} as b, not {_HAS("'global_blurry', 'face_blurry'")} as e, len(r) = 0 as f from c),
            s as (select 0 as stage_no, 'all' as stage, count(*) as n from k union all select 1, 'measured', count(*) filter (a) from k union all select 2, 'one_face', count(*) filter (a and b) from k
            union all select 3, 'sharp', count(*) filter (a and b and e) from k union all select 4, 'eligible', count(*) filter (a and b and e and f) from k)
            select stage_no, stage, n, {_share('n', '(select n from s where stage_no = 0)')} as share_e4 from s""",
        "shot_types": f"select seq, case when {_n('face_area_ratio')} >= 0.12 then 'CLOSE_UP' when {_n('face_area_ratio')} >= 0.04 then 'UPPER_BODY' when {_n('face_area_ratio')} is not null then 'FULL_BODY' end as shot from step3_dataset_report",
        "eye_validity": f"""with e as (select seq, {_n('left_eye_presence_ratio')} as l, {_n('right_eye_presence_ratio')} as r from step3_dataset_report), m as (select seq, l, r, case when l is not null and r is not null then least(l, r) else coalesce(l, r) end as lo, case when l is not null and r is not null then greatest(l, r) else coalesce(l, r) end as hi from e)
            select seq, (lo >= 0.07::double) and ((l + r) / 2 >= 0.08::double) and (hi / greatest(lo, 0.0001::double) <= 2.2::double) as valid from m""",
        "beauty_flag": f"""select seq, coalesce(facemesh_detected and shot_type in ('CLOSE_UP', 'UPPER_BODY') and (({_n('skin_texture_score')} < case when shot_type = 'CLOSE_UP' then 0.05 else 0.035 end) or ({_n('plasticity_ratio')} > 45)), false) as flag from step3_dataset_report""",
        "visibility_score": f"{_VIS} select seq, score, level, level in ('moderate', 'heavy', 'unknown') as occluded, signals from w",
        "dense_percentile": _dense("step3_dataset_report", "laplacian_score", _OK),
        "midrank_percentile": _mid("step3_dataset_report", "face_laplacian_score", _ONE_FACE),
        "sharpness_score": f"select a.seq, a.pct * 0.5::double + b.pct * 0.5::double as score from ({_mid('step3_dataset_report', 'face_laplacian_score', _ONE_FACE)}) a join ({_mid('step3_dataset_report', 'face_tenengrad_score', _ONE_FACE)}) b using (seq)",
        "quality_rank": f"select seq, row_number() over (order by a.pct + b.pct desc, seq) as quality_rank from ({_dense('step3_dataset_report', 'laplacian_score', _OK2)}) a join ({_dense('step3_dataset_report', 'tenengrad_score', _OK2)}) b using (seq)",
        "image_stats_by_scene": f"select {_scene('filename')} as scene, {stats('brightness_mean', 100, 150)} from step3_dataset_report where brightness_mean is not null and not isnan(brightness_mean) group by 1",
        "event_stats_by_user": f"select user_id, {stats('value', 10, 90)} from events where value is not null and not isnan(value) group by 1",
        "summary_stats": f"with v as (select {_n('face_brightness_mean')} as x from step3_dataset_report) select case when count(x) > 0 then {two('min(x)')} || ' / ' || {two('median(x)')} || ' / ' || {two('max(x)')} else 'n/a' end as summary from v",
        "primary_face": "select frame_id, seq, area as box_area from (select *, face_bbox_width::bigint * face_bbox_height as area, row_number() over (partition by frame_id order by face_bbox_width::bigint * face_bbox_height desc, seq) rn from step3_dataset_report where face_bbox_width is not null and face_bbox_height is not null) where rn = 1",
        "nearest_face": "with g as (select frame_id, seq, (face_bbox_x - width / 2) * (face_bbox_x - width / 2) + (face_bbox_y - height / 2) * (face_bbox_y - height / 2) as gap from step3_dataset_report) select frame_id, seq, gap from (select *, row_number() over (partition by frame_id order by gap, seq) rn from g where gap is not null) where rn = 1",
        "first_rows": "select seq, frame_id from step4_dataset_report order by seq limit 100",
        "scene_parse": f"select seq, {_scene('filename')} as scene, {_index('filename')} as idx from step4_dataset_report",
        "path_resolution": f"select seq, case when {_path('group_best')} <> '' and not list_has_any(string_split({_path('group_best')}, '/'), ['', '.', '..']) and not regexp_matches({_path('group_best')}, '^[A-Za-z]:') then {_path('group_best')} end as safe, lower(regexp_extract({_base('group_best')}, '.\\.([^.]*)$', 1)) as ext from step5_dataset_report",
        "resolve_sources": f"""with s as (select seq, case when {_path('group_best')} <> '' and not list_has_any(string_split({_path('group_best')}, '/'), ['', '.', '..']) then {_path('group_best')} end as safe from step5_dataset_report),
            a as (select distinct {_path('filename')} as f from step3_dataset_report), b as (select distinct {_path('filename')} as f from step4_dataset_report)
            select seq, coalesce('a/' || a.f, 'b/' || b.f) as source from s left join a on a.f = safe left join b on b.f = safe""",
        "pose_buckets": """with p as (select seq, pose_yaw as y, case when pose_pitch > 90 then 180 - pose_pitch when pose_pitch < -90 then -180 - pose_pitch else pose_pitch end as p, pose_roll as r from step4_dataset_report)
            select seq, case when y is null or p is null or r is null or isnan(y) or isnan(p) or isnan(r) then null when abs(p) > 35 or abs(r) > 35 then 'EXTREME_POSE' when p > 20 then 'LOOKING_DOWN' when p < -20 then 'LOOKING_UP' when abs(y) <= 15 then 'FRONT'
            when abs(y) <= 42 then (case when y > 0 then 'RIGHT_3Q' else 'LEFT_3Q' end) else (case when y > 0 then 'RIGHT_PROFILE' else 'LEFT_PROFILE' end) end as bucket from p""",
        "pose_distribution": f"select pose_bucket, count(*) as n, {_share('count(*)', 'sum(count(*)) over ()')} as share_e4 from step4_dataset_report where pose_bucket is not null group by 1",
        "top_pose_clusters": "select pose_cluster_key, count(*) as n, min(seq) as first_seq from step4_dataset_report where pose_cluster_key is not null group by 1 order by 2 desc, 3 limit 5",
        "equidistant_sampling": f"{_FRAMES} select video, idx::int as idx, t, frame from plan",
        "single_frame_sampling": f"{_FRAMES} select video, 1 as idx, (s + e) / 2 as t, printf('%s_%03d.png', regexp_replace(video, '^(.+)\\.[^.]*$', '\\1'), 1) as frame from span",
        "skip_existing": f"{_FRAMES} select frame from plan where frame not in (select {_base('filename')} from step3_dataset_report)",
        "extract_summary": f"{_FRAMES} select video, count(*) filter (frame in (select {_base('filename')} from step3_dataset_report)) as frames_extracted, count(*) as target_frames from plan group by 1",
        "status_counts": "select count(*) filter (status = 'ok') as succeeded, count(*) filter (coalesce(status <> 'ok', true)) as failed from step3_dataset_report",
        "align16": f"select p_partkey, {align('p_size * 37')} as aligned from part",
        "candidate_names": f"{_CAND} select seq, name from cand",
        "packaged_names": f"{_CAND}, n as (select seq, width, row_number() over (order by name, seq) as idx from cand) select seq, printf('character_%02d.png', idx) as final_filename from n where width is not null",
        "ranked_layouts": f"{_CAND} select filename as source, unnest({folders}) || '/' || name as target from cand",
        "cluster_review_names": f"""select filename as source, duplicate_group || '/' || printf('%s_q%.1f_eye%.1f_%s', case when duplicate_status = 'representative' then 'WINNER' else 'DUP' end, floor(coalesce(fq, 0) * 10 + 0.5) / 10, floor(coalesce(ey, 0) * 10 + 0.5) / 10, {_base('filename')}) as target
            from (select *, case when not isnan(face_quality_score) then face_quality_score end as fq, case when not isnan(eye_sharpness) then eye_sharpness end as ey from step5_dataset_report) where group_size > 1""",
        "representative_names": f"select filename as source, 'representatives/' || coalesce(shot_type, 'UNKNOWN') || '_' || coalesce(pose_bucket, 'UNKNOWN') || '_' || {_base('filename')} as target from step5_dataset_report where duplicate_status in ('representative', 'unique')",
        "name_classes": f"{_CAND} select seq, {_SHOT_NAME} as shot_type, {_POSE_NAME} as pose_bucket from cand",
        "review_ratio": f"""{_CAND}, k as (select {_SHOT_NAME} as shot_type, count(*) as n from cand group by 1), t(shot_type, target_pct) as (values ('CLOSE_UP', 18::double), ('UPPER_BODY', 62::double), ('FULL_BODY', 20::double)),
            j as (select shot_type, coalesce(n, 0) as n, target_pct from k full join t using (shot_type)) select shot_type, n, target_pct, {_share('n', 'sum(n) over ()')} as share_e4 from j""",
        "similarities": f"""with v as (select vec_id, label, list_transform(embedding, lambda x: x::double) as e, row_number() over (partition by label order by vec_id) rn from embeddings),
            m as (select label, i, avg(e[i]) as x from v, range(1, 65) r(i) where rn <= 20 group by 1, 2), c as (select label, list(x order by i) as raw from m group by 1),
            u as (select label, list_transform(raw, lambda x: x / sqrt(list_inner_product(raw, raw))) as c from c),
            s as (select v.vec_id, list_inner_product(v.e, u.c) / sqrt(list_inner_product(v.e, v.e)) as mean, (select max(list_inner_product(v.e, a.e) / sqrt(list_inner_product(v.e, v.e) * list_inner_product(a.e, a.e))) from v a where a.label = v.label and a.rn <= 20) as best from v join u using (label))
            select vec_id, {_e('mean', 4)} as mean_e4, {_e('best', 4)} as max_e4 from s""",
        "hash_hamming": """with v as (select vec_id, label, list_transform(embedding, lambda x: x::double) as e from embeddings), h as (select vec_id, label, e, list_sort(e[9:64]) as s from v),
            b as (select vec_id, label, list_transform(e, lambda x: x > (s[28] + s[29]) / 2) as bits, row_number() over (partition by label order by vec_id) rn from h)
            select a.vec_id, len(list_filter(range(1, 65), lambda i: a.bits[i] <> z.bits[i]))::int as distance from b a join b z on z.label = a.label and z.rn = 1""",
        "identity_gate": f"{_IDENT} select seq, {_e('threshold', 4)} as threshold_e4, {_CLASS} as identity_class from t",
        "identity_shares": f"{_IDENT}, k as (select {_CLASS} as c from t) select count(c) as evaluated, count(*) filter (c = 'PASSED') as passed, count(*) filter (c = 'REVIEW') as review, count(*) filter (c = 'REJECT_IDENTITY') as reject_identity from k",
        "identity_rank": f"{_IDENT} select seq, row_number() over (order by sim desc, seq) as identity_rank from t where sim >= threshold",
        "dup_links": f"{_dups(12, 6, 14, 10, 8)} select seq, component, links from comp join links using (seq)",
        "dup_links_strict": f"{_dups(4, 2, 6, 4, 2)} select seq, component, links from comp join links using (seq)",
        "dup_clusters": f"{_CLUSTERS} select * from cl",
        "dup_summary": f"{_CLUSTERS} select count(*) as frames, count(*) filter (duplicate_status <> 'duplicate') as kept, count(*) filter (duplicate_status = 'duplicate') as duplicates, {_share('count(*) filter (duplicate_status = $$duplicate$$)', 'count(*)')} as pruned_e4 from cl",
        "face_quality_scores": f"select seq, {_e(_QUALITY, 4)} as score_e4 from step5_dataset_report",
        "candidate_scores": f"""with p as (select seq, {', '.join(f'{v} as p_{k}' for k, v in _PARTS.items())} from step7_dataset_report)
            select seq, {_e('p_ID + p_Sharp + p_Res + p_Exp + p_Bonus', 4)} as score_e4, {" || '+' || ".join(f"printf('{k}=%.1f', floor(p_{k} * 10 + 0.5) / 10)" for k in ('ID', 'Sharp', 'Res', 'Exp'))} || '+' || printf('Bonus=%d', p_Bonus) as reason from p""",
        "quota_distribution": f"""with k as (select shot_type, count(*) as n from step7_dataset_report where candidate_selected group by 1), t(shot_type, least, most) as (values ('CLOSE_UP', 10, 14), ('UPPER_BODY', 25, 35), ('FULL_BODY', 18, 25)),
            j as (select coalesce(k.shot_type, t.shot_type) as shot_type, coalesce(n, 0) as n, coalesce(least, 0) as least, coalesce(most, 999) as most from k full join t on k.shot_type = t.shot_type) select *, {_share('n', 'sum(n) over ()')} as share_e4 from j""",
        "quota_selection": _selection(),
        "training_guide": f"""{_CAND} select printf('# Training set of %s\n\n## Contents\n- Pictures: %d\n- Close-ups: %d, upper body: %d, full body: %d\n- Sides are multiples of %d\n\n## Captions\nEvery caption names clothing, hair, expression, background and light, so that only the subject binds to the trigger word.\n',
            'character', count(*), count(*) filter (shot_type = 'CLOSE_UP'), count(*) filter (shot_type = 'UPPER_BODY'), count(*) filter (shot_type = 'FULL_BODY'), 16) || '{guide_rest("character")}' as value from cand""",
        "selected_scenes": "select count(distinct scene_group) as scenes from step7_dataset_report where candidate_selected",
        "scene_burst_cap": "select distinct scene_group, case when lower(scene_group) like '%reference%' or lower(scene_group) like '%identity%' then 15 else 8 end as cap from step4_dataset_report",
        "upsert_merge": """with o as (select *, row_number() over (partition by filename order by seq desc) rn from step3_dataset_report where run_id < 500)
            select filename, seq, run_id, shot_type, 0 as part from step3_dataset_report where run_id >= 500 union all
            select filename, seq, run_id, shot_type, 1 from o where rn = 1 and filename not in (select filename from step3_dataset_report where run_id >= 500)""",
        "metadata_join_basename": f"""with r as (select {_base('filename')} as base, max(seq) as report_seq, arg_max(coalesce(shot_type, '~'), seq) as shot_type from step4_dataset_report group by 1)
            select s.seq, r.report_seq, case when r.shot_type is null or r.shot_type = '~' then 'UPPER_BODY' else r.shot_type end as shot_type from step5_dataset_report s left join r on r.base = {_base('s.group_best')}""",
        "metadata_join_substring": "select s.seq, (select arg_min(k.output_folder, k.video) from step1_extract_report k where k.output_folder <> '' and contains(s.filename, k.output_folder)) as output_folder from step4_dataset_report s",
        "first_report_row": f"select base, seq, shot_type from (select {_base('filename')} as base, seq, shot_type, row_number() over (partition by {_base('filename')} order by seq) rn from step3_dataset_report) where rn = 1 and base <> ''",
        "semi_anti_counts": "with c as (select distinct frame_id from step7_dataset_report where candidate_selected) select 'semi' as side, count(*) as n from step3_dataset_report where frame_id in (from c) union all select 'anti', count(*) from step3_dataset_report where frame_id not in (from c)",
        "eligible_rows": "select seq from step7_dataset_report where face_eligible and duplicate_status in ('representative', 'unique') and identity_passed",
        "restoration_plan": f"{_REST} select seq, wanted from r",
        "rollback_decision": f"{_REST} select seq, restoration_status from decided",
        "status_lookup_default": f"{_REST}, l as (select {_base('filename')} as base, arg_max(restoration_status, seq) as st from decided where wanted group by 1) select s.seq, coalesce(l.st, 'untouched_raw_camera') as restoration_status from step4_dataset_report s left join l on l.base = {_base('s.filename')}",
        "caption_text": f"{_CAND} select seq, {caption} as caption from cand",
        "caption_tags": f"{_CAND} select seq, {tags} as tags from cand",
        "caption_files": f"{_CAND} select 'character_' || seq || '.txt' as target, {caption} as text from cand",
        "metadata_jsonl": f"{_CAND} select to_json({{image: 'character_' || seq || '.png', text: {caption}, tags: {tags}, width: {align('width')}, height: {align('height')}, shot_type: shot_type, pose: pose_bucket, restoration: 'untouched_raw_camera'}})::varchar as value from cand where width is not null and height is not null",
        "identity_crops": """with b as (select seq, width as w, height as h, coalesce(face_bbox_x, 0) as x, coalesce(face_bbox_y, 0) as y, coalesce(face_bbox_width, 0) as bw, coalesce(face_bbox_height, 0) as bh from step3_dataset_report where width is not null and height is not null),
            o as (select *, greatest(0, x - trunc(bw * 0.25::double)::int) as l, greatest(0, y - trunc(bh * 0.25::double)::int) as t, least(w, x + bw + trunc(bw * 0.25::double)::int) as r, least(h, y + bh + trunc(bh * 0.25::double)::int) as e,
              trunc(w * 0.5::double)::int as cx, trunc(h * 0.35::double)::int as cy, trunc(least(w, h) * 0.35::double)::int as k from b),
            f as (select *, bw > 0 and bh > 0 and r > l and e > t as ok from o)
            select seq, case when ok then l else greatest(0, cx - k) end as x1, case when ok then t else greatest(0, cy - k) end as y1, case when ok then r else least(w, cx + k) end as x2, case when ok then e else least(h, cy + k) end as y2 from f""",
        "pixel_metrics": """with px as (select vec_id, list_transform(embedding, lambda x: least(greatest(x::double * 400 + 128, 0.0), 255.0)) as p from embeddings),
            g as (select vec_id, p, i // 8 as r, i % 8 as c, case when i // 8 = 0 then 1 else i // 8 - 1 end as u, case when i // 8 = 7 then 6 else i // 8 + 1 end as d, case when i % 8 = 0 then 1 else i % 8 - 1 end as a, case when i % 8 = 7 then 6 else i % 8 + 1 end as b from px, range(64) t(i)),
            m as (select vec_id, p[r * 8 + c + 1] as v, p[u * 8 + c + 1] + p[d * 8 + c + 1] + p[r * 8 + a + 1] + p[r * 8 + b + 1] - 4 * p[r * 8 + c + 1] as l,
              (p[u * 8 + b + 1] - p[u * 8 + a + 1]) + 2 * (p[r * 8 + b + 1] - p[r * 8 + a + 1]) + (p[d * 8 + b + 1] - p[d * 8 + a + 1]) as dx, (p[d * 8 + a + 1] - p[u * 8 + a + 1]) + 2 * (p[d * 8 + c + 1] - p[u * 8 + c + 1]) + (p[d * 8 + b + 1] - p[u * 8 + b + 1]) as dy from g)
            select vec_id, round_even(var_pop(l), 3) as laplacian_score, round_even(avg(dx * dx + dy * dy), 3) as tenengrad_score, round_even(avg(v), 3) as brightness_mean, round_even(stddev_pop(v), 3) as brightness_std, round_even(avg((v < 40)::int), 3) as shadow_pixel_ratio, round_even(avg((v > 235)::int), 3) as highlight_pixel_ratio,
              round_even(quantile_cont(v, 0.9) - quantile_cont(v, 0.1), 3) as contrast_p90_p10, null::varchar as error from m group by vec_id""",
        "head_pose": f"""select seq, {', '.join(f"{_e(f'{c} + 1e-4::double', 2)} as {c}_e2" for c in ('pose_yaw', 'pose_pitch', 'pose_roll'))}, null::varchar as pose_error
            from step4_dataset_report where abs(pose_yaw) <= 85 and abs(pose_pitch) <= 85 and abs(pose_roll) <= 175""",
        "clip_labels": f"""select vec_id, {', '.join(f"[{', '.join(repr(x) for x in v)}][list_position(embedding[{1 + 8 * i}:{8 * i + len(v)}], list_max(embedding[{1 + 8 * i}:{8 * i + len(v)}]))] as {a}" for i, (a, v) in enumerate(captions.PROMPTS.items()))} from embeddings""",
        "safe_parse": "select event_id, try_cast(json_extract_string(props, '$.k') as int) as k, case when try_cast(event_type as int) is null then 'not a number: ' || event_type end as error from events",
        "bursts": f"""with g as (select *, case when ts - lag(ts) over w < interval 10 minutes then 0 else 1 end as new from events window w as (partition by user_id order by ts)), s as (select *, sum(new) over (partition by user_id order by ts) as b from g)
            select user_id, min(ts) as burst_start, count(*) as events, {_e('sum(value)', 2)} as total_e2 from s group by user_id, b""",
    }
