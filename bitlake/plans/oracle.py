"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each string is one statement over the driver's pre-registered views.  The
common prefix rebuilds the fixture log view of FIXTURES.md section 4 from
``events``, parses it and derives the bits; the id queries replay the two
load batches (files up to 2024-01-15, then the rest) with W = 64, L = 3.
"""

from __future__ import annotations

from .registry import BITMAP_END, BITMAP_START, NESTED, TYPES

_PREFIX = r"""
WITH ev AS (
  SELECT event_id,
    CASE WHEN event_id % 97 = 0 THEN 'not-a-time' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS ts_raw,
    'u' || CAST(user_id AS VARCHAR) || '-' || CAST(event_id % 20 AS VARCHAR) AS idf,
    'k' || json_extract_string(props, '$.k') AS cf,
    event_type AS et,
    CASE WHEN event_id % 7 = 0 THEN ''
         WHEN event_id % 11 = 0 THEN event_type || ',,' || event_type
         ELSE event_type || ',v' || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END AS sl,
    CAST(ts AS DATE) AS dt,
    CAST(event_id % 8 AS INTEGER) AS part,
    event_id // 500 AS fkey
  FROM events),
lines0 AS (
  SELECT CASE WHEN event_id % 101 = 0 THEN concat_ws(chr(9), ts_raw, idf, cf, et)
              WHEN event_id % 13 = 0 THEN concat_ws(chr(9), ts_raw, idf, cf, et, sl, 'extra')
              ELSE concat_ws(chr(9), ts_raw, idf, cf, et, sl) END AS value,
         dt, part,
         'pixel/dt=' || strftime(dt, '%Y-%m-%d') || '/part=' || CAST(part AS VARCHAR) || '/'
           || CAST(fkey AS VARCHAR) || '.gz' AS file_path
  FROM ev),
log_line AS (
  SELECT value, dt, part, file_path,
         CAST(sum(length(value) + 1) OVER (PARTITION BY file_path) AS BIGINT) AS file_size
  FROM lines0),
inv AS (SELECT DISTINCT file_path, file_size, dt, part FROM log_line),
parsed AS (
  SELECT value, dt, part, file_path, file_size, CAST(len(pos) AS INTEGER) AS n_pos, pos[1] AS ts_raw,
         try_strptime(pos[1], '%Y-%m-%d %H:%M:%S') AS ts,
         CAST(try_strptime(pos[1], '%Y-%m-%d %H:%M:%S') AS DATE) AS day,
         pos[2] AS idfield, pos[3] AS cfield, pos[4] AS ofield, pos[5] AS sfield_list
  FROM (SELECT *, string_split(value, chr(9)) AS pos FROM log_line) t),
acc AS (SELECT * FROM parsed WHERE n_pos >= 5),
raw_bits AS (
  SELECT 'cfield' AS field, cfield AS row_val, idfield AS col_val, day, dt FROM acc
  UNION ALL SELECT 'ofield', ofield, idfield, day, dt FROM acc
  UNION ALL SELECT 'sfield', unnest(string_split(sfield_list, ',')), idfield, day, dt
            FROM acc WHERE sfield_list <> ''),
bits AS (SELECT DISTINCT field, row_val, col_val, day FROM raw_bits),
b1 AS (SELECT DISTINCT field, row_val, col_val, day FROM raw_bits WHERE dt <= DATE '2024-01-15'),
b2 AS (SELECT DISTINCT field, row_val, col_val, day FROM raw_bits WHERE dt > DATE '2024-01-15'),
rv1 AS (SELECT DISTINCT field, row_val FROM b1),
rv2 AS (SELECT DISTINCT field, row_val FROM b2 EXCEPT SELECT field, row_val FROM rv1),
rd1 AS (SELECT field, row_val,
               CAST(row_number() OVER (PARTITION BY field ORDER BY row_val) - 1 AS BIGINT) AS row_id FROM rv1),
nx1 AS (SELECT field, max(row_id) + 1 AS next_id FROM rd1 GROUP BY field),
rd2 AS (SELECT r.field, r.row_val,
               CAST(coalesce(n.next_id, 0) + row_number() OVER (PARTITION BY r.field ORDER BY r.row_val) - 1
                    AS BIGINT) AS row_id
        FROM rv2 r LEFT JOIN nx1 n ON r.field = n.field),
row_dict AS (SELECT '_test' AS "index", field, row_id, row_val
             FROM (SELECT field, row_val, row_id FROM rd1 UNION ALL SELECT field, row_val, row_id FROM rd2) t),
cv1 AS (SELECT DISTINCT col_val FROM b1),
cr1 AS (SELECT col_val, row_number() OVER (ORDER BY col_val) - 1 AS r FROM cv1),
cd1 AS (SELECT col_val, CAST(((r // 3) // 64) * 3 + r % 3 AS BIGINT) AS shard,
               CAST((((r // 3) // 64) * 3 + r % 3) * 64 + (r // 3) % 64 AS BIGINT) AS col_id FROM cr1),
st1 AS (SELECT shard, (max(col_id) + 1) % 64 AS next_offset FROM cd1 GROUP BY shard),
op1 AS (SELECT shard, next_offset, row_number() OVER (ORDER BY shard) - 1 AS lane
        FROM (SELECT * FROM st1 WHERE next_offset <> 0 ORDER BY shard LIMIT 3) t),
base1 AS (SELECT coalesce(max(shard) + 1, 0) AS base FROM st1),
cv2 AS (SELECT DISTINCT col_val FROM b2 EXCEPT SELECT col_val FROM cv1),
cr2 AS (SELECT col_val, row_number() OVER (ORDER BY col_val) - 1 AS r FROM cv2),
cx2 AS (SELECT c.col_val, c.r % 3 AS lane, o.shard AS oshard, c.r // 3 + coalesce(o.next_offset, 0) AS p
        FROM cr2 c LEFT JOIN op1 o ON o.lane = c.r % 3),
cy2 AS (SELECT col_val, p,
               CASE WHEN oshard IS NOT NULL AND p // 64 = 0 THEN oshard
                    ELSE b.base + (p // 64 - CASE WHEN oshard IS NOT NULL THEN 1 ELSE 0 END) * 3 + lane END AS shard
        FROM cx2, base1 b),
col_dict AS (
  SELECT '_test' AS "index", col_id, shard, col_val FROM cd1
  UNION ALL
  SELECT '_test', CAST(shard * 64 + p % 64 AS BIGINT), CAST(shard AS BIGINT), col_val FROM cy2),
facts AS (
  SELECT b.field, r.row_id, c.col_id, c.shard, b.day
  FROM bits b JOIN row_dict r ON b.field = r.field AND b.row_val = r.row_val
              JOIN col_dict c ON b.col_val = c.col_val),
state AS (
  SELECT "index", shard, max(col_id) AS last_id, count(*) AS ids_used,
         (max(col_id) + 1) % 64 AS next_offset, ((max(col_id) + 1) % 64) = 0 AS "full"
  FROM col_dict GROUP BY "index", shard)
"""

_ROW = "SELECT col_val FROM bits WHERE field = '{f}' AND row_val = '{v}'"
_RANGE = ("SELECT col_val FROM bits WHERE field = '{f}' AND row_val = '{v}' "
          "AND day >= DATE '{s}' AND day < DATE '{e}'")


def _row(f, v):
    return "(" + _ROW.format(f=f, v=v) + ")"


def _range(f, v, s, e):
    return "(" + _RANGE.format(f=f, v=v, s=s, e=e) + ")"


def _topn(field, n=None, filt=None):
    where = f"field = '{field}'"
    if filt:
        where += f" AND col_val IN {filt}"
    lim = f" LIMIT {n}" if n is not None else ""
    return (f'SELECT row_val AS "Key", count(DISTINCT col_val) AS "Count" FROM bits WHERE {where} '
            f'GROUP BY row_val ORDER BY "Count" DESC, "Key" ASC{lim}')


def _nested_calls():
    out = []
    for i in range(NESTED):
        a, b, c = (TYPES[(i + k) % len(TYPES)] for k in range(3))
        cols = (f"SELECT col_val FROM ({_row('cfield', f'k{i}')} UNION "
                f"{_range('sfield', a, f'2024-01-{i % 20 + 1:02}', f'2024-01-{i % 20 + 4:02}')}) a "
                f"EXCEPT SELECT col_val FROM ({_row('ofield', b)} INTERSECT {_row('sfield', c)} "
                f"UNION {_row('cfield', f'k{i + 1}')}) b")
        if i % 3 == 0:
            out.append(f"SELECT CAST({i} AS INTEGER) AS call_no, 'count' AS kind, CAST(NULL AS VARCHAR) AS key, "
                       f"CAST(count(*) AS BIGINT) AS count FROM ({cols}) c")
        else:
            out.append(f"SELECT CAST({i} AS INTEGER) AS call_no, 'bitmap' AS kind, col_val AS key, "
                       f"CAST(NULL AS BIGINT) AS count FROM ({cols}) c")
    return " UNION ALL ".join(out)


_CALLS = {
    "batch_nested": _nested_calls(),
    "row": f"SELECT DISTINCT col_val FROM {_row('ofield', 'click')} t",
    "range": f"SELECT DISTINCT col_val FROM {_range('ofield', 'purchase', '2024-01-05', '2024-01-12')} t",
    "union": f"{_row('sfield', 'view')} UNION {_row('cfield', 'k42')}",
    "intersect": f"{_row('ofield', 'view')} INTERSECT {_row('ofield', 'error')}",
    "difference": f"({_row('ofield', 'signup')} EXCEPT {_row('ofield', 'click')}) EXCEPT {_row('ofield', 'view')}",
    "nested": (f"SELECT col_val FROM ({_row('ofield', 'click')} UNION "
               f"{_range('sfield', 'purchase', '2024-01-10', '2024-01-20')}) a "
               f"EXCEPT SELECT col_val FROM ({_row('cfield', 'k5')} INTERSECT {_row('ofield', 'error')}) b"),
    "count_bitmap": (f"SELECT CAST(count(*) AS BIGINT) AS count FROM "
                     f"({_row('ofield', 'click')} INTERSECT {_row('sfield', 'view')}) t"),
    "topn": _topn("sfield", 10),
    "topn_filtered": _topn("cfield", 5, _row("ofield", "purchase")),
    "batch_calls": (
        f"SELECT CAST(0 AS INTEGER) AS call_no, 'bitmap' AS kind, col_val AS key, CAST(NULL AS BIGINT) AS count "
        f"FROM ({_row('ofield', 'signup')} INTERSECT {_row('cfield', 'k1')}) a "
        f"UNION ALL SELECT CAST(1 AS INTEGER), 'count', CAST(NULL AS VARCHAR), CAST(count(*) AS BIGINT) "
        f"FROM (SELECT DISTINCT col_val FROM {_row('sfield', 'error')} t) c "
        f"UNION ALL SELECT CAST(2 AS INTEGER), 'topn', \"Key\", \"Count\" FROM ({_topn('ofield')}) k"),
}

_BODIES = {
    # A
    "log_scan": "SELECT dt, part, file_path, value FROM log_line",
    "file_inventory": "SELECT file_path, file_size, dt, part FROM inv",
    "file_inventory_files": "SELECT DISTINCT dt, part, true AS has_bytes FROM inv",
    "scan_date_range": "SELECT * FROM inv WHERE dt BETWEEN DATE '2024-01-03' AND DATE '2024-01-05'",
    "scan_bucket_range": "SELECT * FROM inv WHERE part BETWEEN 2 AND 5",
    "scan_owned_buckets": "SELECT * FROM inv WHERE part % 3 = 1",
    "file_cap": "SELECT * FROM inv ORDER BY dt, part, file_path LIMIT 25",
    "unprocessed_files": (
        "SELECT * FROM inv i WHERE NOT EXISTS (SELECT 1 FROM inv m WHERE m.dt <= DATE '2024-01-15' "
        "AND m.dt = i.dt AND m.part = i.part AND m.file_path = i.file_path)"),
    "ingest_report": """
        , pf AS (
          SELECT dt, part, file_path, CAST(max(file_size) AS BIGINT) AS file_size,
                 CAST(count(*) AS BIGINT) AS n_lines,
                 CAST(sum(CASE WHEN n_pos < 5 THEN 1 ELSE 0 END) AS BIGINT) AS n_rejects,
                 CAST(sum(CASE WHEN n_pos >= 5 AND ts IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_bad_time
          FROM parsed GROUP BY dt, part, file_path)
        SELECT * FROM pf
        UNION ALL
        SELECT NULL, NULL, NULL, CAST(sum(file_size) AS BIGINT), CAST(sum(n_lines) AS BIGINT),
               CAST(sum(n_rejects) AS BIGINT), CAST(sum(n_bad_time) AS BIGINT) FROM pf""",
    # B
    "parse_log": "SELECT file_path, ts, idfield, cfield, ofield, sfield_list FROM acc",
    "parse_ts": "SELECT ts_raw, ts, day FROM acc",
    "reject_lines": ("SELECT value, 'positions=' || CAST(n_pos AS VARCHAR) || ' < 5' AS reason, dt, part, file_path "
                     "FROM parsed WHERE n_pos < 5"),
    "filter_empty_list": "SELECT idfield, sfield_list FROM acc WHERE sfield_list <> ''",
    "explode_list": ("SELECT idfield, unnest(string_split(sfield_list, ',')) AS sfield FROM acc "
                     "WHERE sfield_list <> ''"),
    "unpivot_bits": "SELECT field, row_val, col_val, day FROM raw_bits",
    "time_views": "SELECT field, row_val, col_val, day, strftime(day, '%Y%m') AS month FROM bits",
    "shard_of": "SELECT col_val, col_id, shard, col_id % 64 AS offset FROM col_dict",
    # C
    "encode_rows": ("SELECT b.field, r.row_id, b.col_val, b.day FROM bits b "
                    "JOIN row_dict r ON b.field = r.field AND b.row_val = r.row_val"),
    "encode_columns": "SELECT b.field, b.row_val, c.col_id, b.day FROM bits b JOIN col_dict c ON b.col_val = c.col_val",
    "decode_rows": "SELECT b.field, b.row_val, c.col_id, b.day FROM bits b JOIN col_dict c ON b.col_val = c.col_val",
    "decode_columns": ("SELECT b.field, r.row_id, b.col_val, b.day FROM bits b "
                       "JOIN row_dict r ON b.field = r.field AND b.row_val = r.row_val"),
    # D
    "assign_row_ids": 'SELECT "index", field, row_id, row_val FROM row_dict',
    "next_row_id": 'SELECT "index", field, max(row_id) + 1 AS next_id FROM row_dict GROUP BY "index", field',
    "assign_column_ids": 'SELECT "index", col_id, shard, col_val FROM col_dict',
    "shard_state": "SELECT * FROM state",
    "open_shards": ("SELECT CAST(row_number() OVER (ORDER BY shard) - 1 AS INTEGER) AS lane, shard, next_offset "
                    "FROM (SELECT * FROM state WHERE NOT \"full\" ORDER BY shard LIMIT 3) t"),
    "unused_shards": ("SELECT CAST(s % 3 AS INTEGER) AS lane, CAST(s // 3 AS INTEGER) AS step, "
                      "CAST(b.base + s AS BIGINT) AS shard "
                      "FROM (SELECT coalesce(max(shard) + 1, 0) AS base FROM state) b, range(0, 6) t(s)"),
    "dict_integrity": """
        SELECT 'unique_id' AS "constraint", CAST(count(*) AS BIGINT) AS violations, 'row' AS dictionary
          FROM (SELECT 1 FROM row_dict GROUP BY "index", field, row_id HAVING count(*) > 1) a
        UNION ALL SELECT 'unique_value', CAST(count(*) AS BIGINT), 'row'
          FROM (SELECT 1 FROM row_dict GROUP BY "index", field, row_val HAVING count(*) > 1) b
        UNION ALL SELECT 'unique_id', CAST(count(*) AS BIGINT), 'col'
          FROM (SELECT 1 FROM col_dict GROUP BY "index", col_id HAVING count(*) > 1) c
        UNION ALL SELECT 'unique_value', CAST(count(*) AS BIGINT), 'col'
          FROM (SELECT 1 FROM col_dict GROUP BY "index", col_val HAVING count(*) > 1) d""",
    "shard_status": "SELECT *, ids_used / 64.0 AS fill_ratio, shard % 1 = 0 AS owned FROM state",
    # E
    "set_bits": "SELECT * FROM bits",
    "bitmap_index": ("SELECT field, row_id, col_id // 32768 AS bucket, count(DISTINCT col_id) AS n_bits "
                     "FROM facts GROUP BY field, row_id, col_id // 32768"),
    "bitmap_count": (
        f"SELECT 'intersect' AS kind, CAST(count(*) AS BIGINT) AS count FROM "
        f"({_row('ofield', 'click')} INTERSECT {_row('sfield', 'view')}) a "
        f"UNION ALL SELECT 'union', CAST(count(*) AS BIGINT) FROM "
        f"({_row('ofield', 'click')} UNION {_row('sfield', 'view')}) b"),
    "bitmap_topn": _topn("sfield", 10),
    "time_bitmap_index": (
        "SELECT field, row_id, period, col_id // 32768 AS bucket, count(DISTINCT col_id) AS n_bits FROM ("
        "SELECT field, row_id, col_id, unnest([CAST(strftime(day, '%Y%m') AS INTEGER), CAST(strftime(day, '%Y%m%d') AS INTEGER)]) "
        "AS period FROM facts WHERE day IS NOT NULL) p GROUP BY ALL"),
    "bitmap_range": f"SELECT DISTINCT col_val FROM {_range('ofield', 'purchase', BITMAP_START, BITMAP_END)} t",
    "bitmap_difference": _CALLS["difference"],
    "bitmap_nested": _CALLS["nested"],
    # A7-A14, S
    "log_files_scan": "SELECT dt, part, value FROM log_line",
    "mark_files": ("SELECT dt AS day, part AS bucket, '_test' AS \"index\", file_path AS file, "
                   "CAST(CASE WHEN dt <= DATE '2024-01-15' THEN 0 ELSE 1 END AS INTEGER) AS owner_node FROM inv"),
    "marked_files": "SELECT file_path AS file FROM inv WHERE dt = DATE '2024-01-03' AND part = 2",
    "refresh_marks": ("SELECT dt AS day, part AS bucket, '_test' AS \"index\", file_path AS file, "
                      "CAST(1 AS INTEGER) AS owner_node FROM inv WHERE dt > DATE '2024-01-15' "
                      "UNION ALL SELECT dt, part, '_other', file_path, CAST(0 AS INTEGER) FROM inv "
                      "WHERE dt <= DATE '2024-01-15'"),
    "refresh_index": """
        , one_batch AS (SELECT DISTINCT field, row_val, col_val FROM bits)
        SELECT 'fact' AS tbl, CAST(count(*) AS BIGINT) AS rows_before, CAST(0 AS BIGINT) AS rows_after FROM bits
        UNION ALL SELECT 'row_dict', CAST(count(DISTINCT (field, row_val)) AS BIGINT), CAST(0 AS BIGINT) FROM bits
        UNION ALL SELECT 'col_dict', CAST(count(DISTINCT col_val) AS BIGINT), CAST(0 AS BIGINT) FROM bits""",
    "row_dict_load": "SELECT row_val, row_id FROM row_dict WHERE field = 'sfield'",
    "row_dict_append": "SELECT '_test' AS \"index\", field, row_id, row_val FROM rd2",
    "fact_sink": "SELECT * FROM facts",
    "fact_sink_keyed": "SELECT * FROM bits",
    "resume_ingest": "SELECT * FROM bits",
    "resume_topn": _topn("sfield", 10),
    "stream_ingest": "SELECT * FROM bits",
    "resume_ingest_files": "SELECT * FROM bits",
    "load_rejects": ("SELECT value, 'positions=' || CAST(n_pos AS VARCHAR) || ' < 5' AS reason, dt, part, file_path, "
                     "count(*) AS n FROM parsed WHERE n_pos < 5 GROUP BY ALL"),
    "load_report": """
        SELECT dt, part, file_path, CAST(max(file_size) AS BIGINT) AS file_size, count(*) AS n_lines,
               CAST(sum(CASE WHEN n_pos < 5 THEN 1 ELSE 0 END) AS BIGINT) AS n_rejects,
               CAST(sum(CASE WHEN n_pos >= 5 AND ts IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_bad_time
        FROM parsed GROUP BY dt, part, file_path""",
    "stream_after_resume": ("SELECT dt AS day, part AS bucket, CAST(0 AS BIGINT) AS marked_twice, count(*) AS n_lines "
                            "FROM parsed GROUP BY dt, part"),
}


def _full(body: str) -> str:
    b = body.strip()
    if b.startswith(","):
        return _PREFIX + b
    return _PREFIX + " " + b


def oracle_sql() -> dict[str, str]:
    out = {k: _full(v) for k, v in _BODIES.items()}
    for name, body in _CALLS.items():
        out[name] = _full(body)
        out[f"{name}_ids"] = _full(body)
    return out
