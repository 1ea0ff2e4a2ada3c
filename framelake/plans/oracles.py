"""The queries in DuckDB SQL."""

_FENCE = """
m as (select {by}, count(score) as frames_scored, median(score) as med from s group by {by}),
a as (select s.{by}, median(abs(score - med)) as mad from s join m using ({by}) group by s.{by}),
f as (select {by}, frames_scored, case when frames_scored >= 3 then med end as med, case when frames_scored >= 3 then mad end as mad,
  case when frames_scored >= 3 then greatest(med - 3.0 * 1.4826 * mad, 0.0) end as threshold from m join a using ({by}))"""

_FRAMES = """
fr as (select o_custkey as session_id, o_orderkey, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) - 1 as frame_index,
  'frame_' || o_orderkey || '.jpg' as filename from orders)"""

_LINES = """
li as (select l_orderkey as o_orderkey, (l_partkey % 50)::int as id, l_quantity as cx, l_discount * 100 as cy, l_tax + 1 as side, l_tax as score,
  row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount, l_tax) as k from lineitem)"""

_REJECTED = "s as (select o_orderkey, o_orderpriority, ln(o_totalprice) as score from orders)," + _FENCE.format(by="o_orderpriority") + """,
rej as (select distinct o_orderkey from s join f using (o_orderpriority) where score < threshold)"""

_VALID = "id % 3 = 0"

_RASTER = """
r as (select vec_id, label, h, i, i // 8 as y, i % 8 as x, coalesce(embedding[i + 1], 0)::double as v
  from (select *, (len(embedding) + 7) // 8 as h from embeddings), unnest(range(0, 8 * h)) as t(i))"""

# the four neighbours; borders mirror, but in a raster of one line they repeat
_LAPLACE = """
l as (select a.vec_id, a.label, a.h, u.v + d.v + l.v + r2.v - 4 * a.v as x from r a
  join r u on u.vec_id = a.vec_id and u.x = a.x and u.y = case when a.h = 1 then 0 when a.y = 0 then 1 else a.y - 1 end
  join r d on d.vec_id = a.vec_id and d.x = a.x and d.y = case when a.h = 1 then 0 when a.y = a.h - 1 then a.h - 2 else a.y + 1 end
  join r l on l.vec_id = a.vec_id and l.y = a.y and l.x = case when a.x > 0 then a.x - 1 when a.h = 1 then 0 else 1 end
  join r r2 on r2.vec_id = a.vec_id and r2.y = a.y and r2.x = case when a.x < 7 then a.x + 1 when a.h = 1 then 7 else 6 end)"""

_TRACK = """
with recursive e as (
  select user_id, row_number() over (partition by user_id order by ts, event_id) as k, value as area,
    (props->>'$.k')::double / 100 as cov, event_type <> 'signup' as marked,
    case when event_type in ('click', 'view') then 20.0::double end as a1,
    case when event_type in ('click', 'purchase') then (props->>'$.k')::double + 40 end as a2
  from events
), w as (
  select user_id, 0::bigint as k, false as was, false as tracking, null::double as ref, -1 as src from (select distinct user_id from events)
  union all
  select user_id, k, tracking, src < 3, case when src = 3 then null when not marked then ref when src = 0 then area when src = 1 then a1 else a2 end, src
  from (
    select e.*, w.tracking, w.ref,
      case when w.tracking and area > 0 and (not marked or (cov >= 0.5 and coalesce(area / w.ref between 0.5 and 2.0, true))) then 0
           when a1 > 0 and (not marked or coalesce(a1 / w.ref between 0.5 and 2.0, true)) then 1
           when a2 > 0 and (not marked or coalesce(a2 / w.ref between 0.5 and 2.0, true)) then 2 else 3 end as src
    from w join e on e.user_id = w.user_id and e.k = w.k + 1)
)
select user_id, count(*) filter (where src = 0) as frames_tracked, count(*) filter (where src = 1) as frames_dino,
  count(*) filter (where src = 2) as frames_aruco_box, count(*) filter (where src = 3) as frames_fallback_full,
  count(*) filter (where was and src in (1, 2)) as reanchors, count(*) filter (where was and src = 3) as track_resets
from w where k > 0 group by user_id"""

# all events as one session; the step is the same, frame by frame
_LONG = """
with recursive e as materialized (
  select event_id, row_number() over (order by ts, event_id) as k, case when event_id % 40 <> 0 then value end as area,
    (props->>'$.k')::double / 100 as cov, event_type <> 'signup' as marked,
    case when event_id % 40 <> 0 and event_type in ('click', 'view') then 20.0::double end as a1,
    case when event_id % 40 <> 0 and event_type in ('click', 'purchase') then (props->>'$.k')::double + 40 end as a2
  from events
), w as (
  select 0::bigint as k, false as was, false as tracking, null::double as ref, -1 as src, null::bigint as event_id
  union all
  select k, tracking, src < 3, case when src = 3 then null when not marked then ref when src = 0 then area when src = 1 then a1 else a2 end, src, event_id
  from (
    select e.*, w.tracking, w.ref,
      case when w.tracking and area > 0 and (not marked or (cov >= 0.5 and coalesce(area / w.ref between 0.5 and 2.0, true))) then 0
           when a1 > 0 and (not marked or coalesce(a1 / w.ref between 0.5 and 2.0, true)) then 1
           when a2 > 0 and (not marked or coalesce(a2 / w.ref between 0.5 and 2.0, true)) then 2 else 3 end as src
    from w join e on e.k = w.k + 1)
)
select event_id, src as source, (was and src in (1, 2))::integer as reanchor, (was and src = 3)::integer as track_reset from w where k > 0"""

# frames that are held back and come when the watermark, two days behind the newest of all others, has passed them
_ON_TIME = """
r as (select * from events where event_id % 97 <> 0 or ts > (select max(ts) from events where event_id % 97 <> 0) - interval 2 day)"""
_TRACK_ON_TIME = _TRACK.replace("with recursive e as", "with recursive" + _ON_TIME + ",\ne as").replace("  from events\n)", "  from r\n)").replace("from (select distinct user_id from events)", "from (select distinct user_id from r)")

ORACLES = {
    "robust_fence_stats": "with s as (select event_id, event_type, ln(value + 1) as score from events)," + _FENCE.format(by="event_type") + """
select event_type, f.frames_scored, round(med, 6) as median, round(mad, 6) as mad, round(threshold, 6) as threshold,
  (select count(*) from s where s.event_type = f.event_type and score < threshold) as frames_rejected from f""",
    "robust_fence_rejects": "with s as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, ln(l_extendedprice) as score from lineitem)," + _FENCE.format(by="l_returnflag") + """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag from s join f using (l_returnflag) where score < threshold""",
    "robust_fence_growing": "with t as (select l_returnflag, l_orderkey % 3 as day, ln(l_extendedprice) as score from lineitem), s as (select l_returnflag || k as g, l_returnflag, k, score from t, unnest(range(1, 4)) as u(k) where day < k)," + _FENCE.format(by="g") + """
select x.l_returnflag, x.k as days, f.frames_scored, round(med, 6) as median, round(mad, 6) as mad, round(threshold, 6) as threshold from f join (select distinct g, l_returnflag, k from s) x using (g)""",
    "stride_sample": """
select user_id, event_id as frame_index, round(event_id / 29.97::double, 4) as timestamp_s,
  'frame_' || lpad(event_id::varchar, length((select count(*) from events)::varchar)::int, '0') || '.jpg' as filename
from events where event_id % 7 = 0""",
    "frames_left_detections": "with" + _FRAMES + "," + _LINES + """,
n as (select o_orderkey, count(*) as m from li group by 1)
select session_id, count(*) as total_frames, count(*) filter (where m > 0) as frames_with_detections, coalesce(sum(m), 0)::bigint as markers
from fr left join n using (o_orderkey) group by 1""",
    "whitelist_markers": "with" + _LINES + f"""
select o_orderkey, count(*) as before, count(*) filter (where {_VALID}) as after,
  coalesce(string_agg(id::varchar, ',' order by k) filter (where {_VALID}), '') as ids from li group by 1""",
    "zip_shorter": "with" + _LINES + "select o_orderkey, count(*) as n, string_agg(id::varchar, ',' order by k) as ids from li where k <= 3 group by 1",
    "min_marker_filter": "with" + _FRAMES + "," + _LINES + """,
n as (select o_orderkey, count(*) as m from li group by 1)
select session_id, frame_index, filename, m as markers_detected from fr join n using (o_orderkey) where m >= 3""",
    "anti_reject_set": "with" + _FRAMES + "," + _REJECTED + " select o_orderkey, session_id, frame_index from fr where o_orderkey not in (select o_orderkey from rej)",
    "semi_exists": "with" + _FRAMES + " select o_orderkey, session_id, frame_index from fr where o_orderkey in (select l_orderkey from lineitem where l_returnflag = 'R')",
    "selection_manifest": "with" + _FRAMES + "," + _LINES + "," + _REJECTED + f""",
n as (select o_orderkey, count(*) filter (where {_VALID}) as m from li group by 1),
k as (select fr.*, m from fr join n using (o_orderkey) where m >= 1 and o_orderkey not in (select o_orderkey from rej)),
g as (select session_id, count(*) as kept, sum(m)::bigint as markers, min(frame_index) as first_frame, string_agg(filename, ',' order by frame_index) as frames from k group by 1),
t as (select session_id, count(*) as total_frames_input from fr group by 1)
select session_id, total_frames_input, total_frames_input - coalesce(kept, 0) as frames_filtered_out, coalesce(markers, 0) as markers, first_frame, coalesce(frames, '') as frames
from t left join g using (session_id)""",
    "camera_left_join": """
select s.session_id, c.c_custkey is not null as has_camera, case when c_acctbal > 5000 then c_acctbal end as focal_length_35mm,
  c_nationkey::bigint as width_px, length(c_name)::bigint as height_px
from (select distinct o_custkey as session_id from orders) s left join (select * from customer where c_acctbal > 0) c on c.c_custkey = s.session_id""",
    "map_last_wins": "select conv_id, role, max_by(text, turn) as text from conversations group by 1, 2",
    "box_prompt": "with" + _LINES + """,
b as (select o_orderkey, min(cx - side / 2) as x0, min(cy - side / 2) as y0, max(cx + side / 2) as x1, max(cy + side / 2) as y1, 2.0 * median(side) as pad
  from li group by 1 having count(*) >= 3)
select o_orderkey, round(least(greatest(x0 - pad, 0), 59), 6) as x0, round(least(greatest(y0 - pad, 0), 19), 6) as y0,
  round(least(greatest(x1 + pad, 0), 59), 6) as x1, round(least(greatest(y1 + pad, 0), 19), 6) as y1 from b""",
    "marker_centers_sides": "with" + _LINES + "select o_orderkey, round(sum(cx), 6) as sum_x, round(sum(cy), 6) as sum_y, round(median(side), 6) as median_side from li group by 1",
    "point_in_box_top1": "with" + _LINES + """,
c as (select o_orderkey, k, score, (0.0::double + (cx - side / 2) + (cx + side / 2) + (cx + side / 2) + (cx - side / 2)) / 4 as cx,
  (0.0::double + (cy - side / 2) + (cy - side / 2) + (cy + side / 2) + (cy + side / 2)) / 4 as cy from li),
p as (select a.o_orderkey, a.k, a.cx - 10 as x0, a.cy - 3 as y0, a.score,
    count(*) filter (where b.cx between a.cx - 10 and a.cx + 10 and b.cy between a.cy - 3 and a.cy + 3) as n
  from c a join c b using (o_orderkey) group by all),
q as (select *, row_number() over (partition by o_orderkey order by n desc, score desc, k) as r from p where n > 0)
select o_orderkey, round(x0, 6) as x0, round(y0, 6) as y0, round(score, 6) as score from q where r = 1""",
    "crowded_frame": """
with p as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice::double as x, l_quantity::double as y, l_tax::double as score, 50 + l_suppkey % 4 * 100 as w from lineitem),
c as (select x, y, count(*) as m from p group by all),
u as (select distinct x, y, w from p),
h as (select u.x, u.y, u.w, sum(m)::bigint as held from u join c on c.x >= u.x - u.w and c.x <= u.x + u.w and c.y >= u.y - 1 and c.y <= u.y + 1 group by all),
r as (select p.*, held, l_orderkey * 10 + l_linenumber as place from p join h using (x, y, w))
select l_orderkey, l_linenumber, l_partkey, l_suppkey, held, place = (select place from r order by held desc, score desc, place limit 1) as best from r""",
    "coverage_and_area": "with" + _RASTER + """,
n as (select vec_id, label, h, count(*) filter (where v > 0) as n from r group by 1, 2, 3),
p as (select vec_id, round_even(2.5 * i, 0)::int as x, least((label + i) % 9, h - 1) as y from n, unnest(range(0, 3)) as t(i)),
c as (select p.vec_id, avg((v > 0)::int::double) as coverage from p join r on r.vec_id = p.vec_id and r.x = p.x and r.y = p.y group by 1)
select vec_id, round(coverage, 6) as coverage, round(n / ((label % 3 + 1) * (label % 3 + 1))::double, 6) as area, n > 0 as any_pixel from n join c using (vec_id)""",
    "laplacian_sharpness": "with" + _RASTER + "," + _LAPLACE + """
select e.vec_id, round(s, 6) as sharpness from (select vec_id, row_number() over (partition by vec_id) as n from embeddings) e left join (select vec_id, var_pop(x) as s from l group by 1) using (vec_id)""",
    "pixel_union_dilate": "with" + _RASTER + """,
u as (select vec_id, i, y, x, v > 1.0 or (y between label % 4 and label % 4 + 4 and x between label % 4 and label % 4 + 4) as b from r),
g as (select a.vec_id, a.i, bool_or(n.b) as g from u a join u n on n.vec_id = a.vec_id and abs(n.x - a.x) + abs(n.y - a.y) <= 1 group by 1, 2)
select vec_id, count(*) filter (where g) as n_grown, string_agg(case when g then '1' else '0' end, '' order by i) as bits from g group by 1""",
    "pixel_runs": "with" + _RASTER + """,
u as (select vec_id, i, y, x, label, h, v > 1.0 or (y between label % 4 and label % 4 + 4 and x between label % 4 and label % 4 + 4) as b from r),
g as (select a.vec_id, a.y, a.x from u a join u n on n.vec_id = a.vec_id and abs(n.x - a.x) + abs(n.y - a.y) <= 1 group by all having bool_or(n.b)),
k as (select *, x - row_number() over (partition by vec_id, y order by x) as run from g),
s as (select vec_id, y, min(x) as lo, max(x) as hi from k group by vec_id, y, run),
c as (select vec_id, label, label % 4 + 4 * p[1] as px, label % 4 + 4 * p[2] as py from embeddings, unnest([[0, 0], [1, 0], [1, 1], [0, 1]]) as t(p)),
v as (select c.vec_id, avg(coalesce(r.v > 0, false)::int) as coverage from c left join r on r.vec_id = c.vec_id and r.x = least(px, 7) and r.y = least(py, 7) group by 1)
select vec_id, y::bigint as y, lo::bigint as lo, hi::bigint as hi, (sum(hi - lo + 1) over (partition by vec_id))::bigint as area, coverage from s join v using (vec_id)""",
    "image_scan": "with" + _RASTER.replace("coalesce(embedding[i + 1], 0)::double", "least(255, greatest(0, round_even(128 + 32 * coalesce(embedding[i + 1], 0)::double, 0)))") + "," + _LAPLACE + """
select 's' || label as session_id, vec_id, h::bigint as height, 8::bigint as width, round(var_pop(x), 6) as sharpness from l group by vec_id, label, h""",
    "mjpeg_source": """
with v as (select n_nationkey, n_name, 2 * n_nationkey + 1 as n from nation)
select 'n' || n_nationkey as session_id, n::bigint as total_frames, 64::bigint as width, 48::bigint as height, i::bigint as frame_index, round(i / 25.0::double, 4) as timestamp_s,
  'frame_' || lpad(i::varchar, length(n::varchar)::int, '0') || '.jpg' as filename, n_name || ' ' || i as shot
from v, unnest(range(0, n, 3)) as t(i)""",
    "video_ranges": """
with v as (select 's' || s_suppkey as session_id, s_name, s_suppkey % 40 + 1 as n from supplier),
f as (select session_id, n::bigint as total_frames, i::bigint as frame_index, s_name || ' ' || i as shot from v, unnest(range(0, n)) as t(i))
select 'one' as part, * from f where session_id = 's7' and frame_index >= 2
union all select 'every', * from f where frame_index > 10 and frame_index <= 21 and frame_index % 2 = 0""",
    "committed_files": """
select 'n' || c_nationkey || '/c' || c_custkey || '.txt' as name, 1::bigint as times, c_custkey || '|' || c_name || '|' || c_mktsegment as text,
  octet_length(encode(c_custkey || '|' || c_name || '|' || c_mktsegment))::bigint as listed_bytes from customer""",
    "marker_detect": """
with s as (select s_suppkey, 60 + 6 * (s_suppkey % 4) as side, 20 + s_suppkey % 7 as m from supplier)
select s_suppkey, 1::bigint as markers, (s_suppkey % 50)::bigint as id, m::bigint as left, m::bigint as top, (m + side - 1)::bigint as right, (m + side - 1)::bigint as bottom from s""",
    "mask_png": """
select 'n' || n_nationkey as session_id, 'f' || i || '.jpg.png' as filename, (10 * (n_nationkey % 5 + 3))::bigint as white, 1::bigint as frames_dino, 2::bigint as frames_tracked, 'cpu' as device
from nation, unnest(range(0, 3)) as t(i)""",
    "manifest_document": "with" + _FRAMES + "," + _LINES + "," + _REJECTED + f""",
n as (select o_orderkey, count(*) as m, string_agg(id::varchar, ',' order by k) as ids from li where {_VALID} group by 1),
k as (select fr.*, m, ids from fr join n using (o_orderkey) where o_orderkey not in (select o_orderkey from rej)),
g as (select session_id, count(*) as kept, string_agg(filename, ',' order by frame_index) as frames, string_agg(ids, ',' order by frame_index) as ids from k group by 1),
t as (select session_id, count(*) as total from fr group by 1)
select session_id, case when c_custkey is null then '' else 'camera,' end || 'dictionary,frames,frames_filtered_out,marker_detections,min_markers,total_frames_input' as keys,
  'DICT_4X4_250' as dictionary, 1::bigint as min_markers, total as total_frames_input, total - coalesce(kept, 0) as frames_filtered_out, coalesce(frames, '') as frames, coalesce(ids, '') as ids,
  case when c_custkey is not null then 640::bigint end as width_px, c_custkey is not null as null_kept
from t left join g using (session_id) left join (select * from customer where c_acctbal > 0) c on c.c_custkey = t.session_id""",
    "tracking_fold": _TRACK,
    "tracking_long_session": _LONG,
    "tracking_stream": _TRACK,
    "tracking_ordered": _TRACK_ON_TIME.replace(" as track_resets\n", " as track_resets, null::bigint as late\n") + """
union all select null, null, null, null, null, null, null, (select count(*) from events) - (select count(*) from r)""",
    "tracking_memory": _TRACK_ON_TIME[: _TRACK_ON_TIME.index("select user_id, count(*) filter (where src = 0)")].replace("select user_id, row_number() over", "select user_id, event_id, row_number() over") + """,
a as (select user_id, k, src, max(case when src in (1, 2) and not was then k end) over (partition by user_id order by k) as start from w where k > 0)
select a.user_id, e.event_id, a.k as frame, case when src = 3 then '' else array_to_string(list_distinct_sorted, ',') end as kept
from (select *, list_sort(list_distinct(list_concat([start], range(greatest(start, k - 7), k + 1)))) as list_distinct_sorted from a) a
join e on e.user_id = a.user_id and e.k = a.k""",
    "video_stream": """
select 's' || s_suppkey as session_id, (s_suppkey % 9)::bigint as frames, (s_suppkey % 9)::bigint as numbers, (s_suppkey % 9)::bigint as total_frames
from supplier where s_suppkey % 9 > 0""",
    "source_counts": """
select user_id, count(*) filter (where event_type = 'click') as frames_tracked, count(*) filter (where event_type = 'view') as frames_dino,
  count(*) filter (where event_type = 'purchase') as frames_aruco_box, count(*) filter (where event_type not in ('click', 'view', 'purchase')) as frames_fallback_full
from events group by 1""",
    "last_reference": """
select event_id, round(last_value(case when event_type <> 'signup' then value end ignore nulls)
  over (partition by user_id order by ts, event_id rows between unbounded preceding and 1 preceding), 6) as reference from events""",
    "regex_probe": r"""
with p as (select page_id, concat_ws(' ', url, html) as t from pages),
h as (select page_id, regexp_extract_all(t, '(?:page=|track\(|/)(\d+)(?:/(\d+))?', 1) as a, regexp_extract_all(t, '(?:page=|track\(|/)(\d+)(?:/(\d+))?', 2) as b from p),
v as (select page_id, i, a[i]::double / nullif(case when coalesce(b[i], '') = '' then 1.0 else b[i]::double end, 0) as v from h, unnest(range(1, len(a) + 1)) as t(i))
select h.page_id, (select count(*) from v where v.page_id = h.page_id and v is not null) as hits,
  (select min_by(v.v, i) from v where v.page_id = h.page_id and v.v between 10 and 200) as focal_35mm from h""",
    "focal_probe": r"""
with p as (select page_id, page_id % 5 as k, page_id % 240 as n, coalesce(html, '') as h from pages),
t as (select page_id, h || case when k = 0 then 'exif:focallengthIn35mmFilm="' || n || '"' when k = 1 then 'exif:focallengthIn35mmFilm><' || n * 10 || '/10'
  when k = 2 then 'com.apple.quicktime.camera.focal_length.35mm_equivalent' || chr(0) || chr(1) || 'data ' || n || '.5mm'
  when k = 3 then 'exif:focallengthIn35mmFilm><7/0 com.apple.quicktime.camera.focal_length.35mm_equivalent 31' else '' end as t from p),
h as (select page_id, t, regexp_extract_all(t, '(?i)FocalLengthIn35mmFilm[^0-9]{0,4}(\d+)(?:/(\d+))?', 1) as a, regexp_extract_all(t, '(?i)FocalLengthIn35mmFilm[^0-9]{0,4}(\d+)(?:/(\d+))?', 2) as b,
  strpos(t, 'com.apple.quicktime.camera.focal_length.35mm_equivalent') as place from t),
v as (select page_id, i, a[i]::double / nullif(case when coalesce(b[i], '') = '' then 1.0 else b[i]::double end, 0) as v from h, unnest(range(1, len(a) + 1)) as t(i)),
x as (select h.page_id, case when place > 0 then nullif(regexp_extract(substr(t, place + length('com.apple.quicktime.camera.focal_length.35mm_equivalent'), 64), '(\d+(?:\.\d+)?)', 1), '')::double end as apple from h)
select x.page_id, (select count(*) from v where v.page_id = x.page_id and v is not null) as hits, apple,
  coalesce((select min_by(v.v, i) from v where v.page_id = x.page_id and v.v between 10 and 200), case when apple between 10 and 200 then apple end) as focal_35mm from x""",
    "json_required_keys": """
select event_id, array_to_string(list_filter(['k', 'fps', 'stride'], lambda x: not list_contains(coalesce(json_keys(props), []), x)), ',') as missing,
  (props->>'$.k')::bigint as k from events""",
    "document_scan": """
with e as (select *, event_id % 10 as k, event_id % 50 = 6 as none from events)
select 'event ' || event_id as source, case when k in (5, 6, 7, 8, 9) and not none then event_id end as frame_index,
  case when k in (5, 6, 7, 8, 9) and not none then round(value, 2) end as timestamp_s, case when k in (6, 7, 8, 9) and not none then event_type end as filename,
  case when none then 'no text' when k = 0 then 'broken JSON' when k = 1 then 'missing keys filename' when k = 2 then 'missing keys frame_index, filename'
    when k = 3 then 'other types timestamp_s' when k = 4 then 'not an object' end as fault
from e""",
    "config_precedence": """
select c_custkey, coalesce(case when c_custkey % 3 = 0 then c_nationkey end, case when c_custkey % 2 = 0 then c_nationkey + 100 end, 1)::bigint as stride,
  coalesce(nullif(case when c_custkey % 5 = 0 then '' when c_custkey % 7 = 0 then c_mktsegment end, ''), 'head.') as prompt from customer""",
    "sheet_layout": """
with c as (select 236 / 300::double * 25.4 as side, 210.0::double as w, 297.0::double as h),
g as (select side, greatest(1, floor((w - 30) / (side + 8)))::bigint as cols, greatest(1, floor((h - 30) / (side + 14)))::bigint as rows from c),
p as (select p_partkey, p_partkey as i, g.* from part, g)
select p_partkey, i // (cols * rows) as page, i % (cols * rows) % cols as col, i % (cols * rows) // cols as row,
  round(15 + (i % (cols * rows) % cols) * (side + 8), 3) as x, round(15 + (i % (cols * rows) // cols) * (side + 14), 3) as y,
  354::bigint as total_pixels, round(side, 3) as side_mm, p_partkey::varchar as label from p""",
    "dictionary_lookup": """
with k(name, code) as (values ('DICT_4X4_50', 0), ('DICT_4X4_100', 1), ('DICT_4X4_250', 2), ('DICT_5X5_50', 4), ('DICT_5X5_100', 5), ('DICT_6X6_50', 8)),
p as (select p_partkey, ['DICT_4X4_100', 'DICT_4X4_250', 'DICT_4X4_50', 'DICT_5X5_100', 'DICT_5X5_50', 'DICT_6X6_50', 'DICT_7X7_50'][p_partkey % 7 + 1] as name from part)
select p_partkey, name, code::bigint as code from p left join k using (name)""",
}
