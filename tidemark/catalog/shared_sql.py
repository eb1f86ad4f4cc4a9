"""The views of `plans.views`, stated in SQL. Times are epoch milliseconds."""

from tidemark.catalog.registry import view

BASE = 1_704_067_200_000

view(
    "v_files",
    f"""
SELECT n, lower(path) AS doc_id, path, content, {BASE} + n * 1000 AS mtime_ms, lang, source FROM (
  SELECT doc_id AS n, lpad(((doc_id * 7) % 230)::VARCHAR, 3, '0') || '/' || source || '/' || doc_id || '.' ||
    CASE doc_id % 4 WHEN 0 THEN 'md' WHEN 1 THEN 'txt' WHEN 2 THEN 'json' ELSE 'png' END AS path,
    text AS content, lang, source
  FROM documents)""",
)
view(
    "v_chunks",
    """
SELECT n, doc_id, pos, array_slice(raw, pos * 1024 + 1, (pos + 1) * 1024) AS piece,
  sha256(array_slice(raw, pos * 1024 + 1, (pos + 1) * 1024)) AS chunk_id
FROM (SELECT n, doc_id, encode(content) AS raw,
        unnest(range(greatest((octet_length(encode(content)) + 1023) // 1024, 1))) AS pos
      FROM v_files)""",
)
view(
    "v_prev",
    "SELECT path, content, sha256(content) AS hash, mtime_ms FROM v_files",
)
view(
    "v_curr",
    f"""
SELECT path, content, sha256(content) AS hash, mtime_ms FROM (
  SELECT f.path, CASE WHEN l.quality = 0 THEN f.content || chr(10) || 'edited' ELSE f.content END AS content,
    f.mtime_ms + CASE WHEN l.quality IS NOT NULL THEN 3600000 ELSE 0 END AS mtime_ms
  FROM v_files f LEFT JOIN labels l ON l.doc_id = f.n WHERE coalesce(l.toxic, 0) = 0
  UNION ALL
  SELECT '200/pages/' || page_id || '.html', html, {BASE} + page_id * 1000 FROM pages)""",
)
view(
    "v_changes",
    """
SELECT path, c.hash AS hash, c.mtime_ms AS mtime_ms,
  CASE WHEN c.hash IS NULL THEN 'deleted' WHEN p.hash IS NULL THEN 'added'
       WHEN p.hash = c.hash AND p.mtime_ms = c.mtime_ms THEN 'unchanged' ELSE 'modified' END AS status
FROM v_prev p FULL OUTER JOIN v_curr c USING (path)""",
)
view(
    "v_sides",
    f"""
SELECT n, doc_id, path, content AS base,
  CASE WHEN n % 2 = 0 THEN 'local ' || content ELSE content END AS local,
  CASE WHEN n % 15 = 0 THEN 'remote ' || content
       WHEN n % 3 = 0 THEN left(content, length(content) - length(last)) || 'remote ' || last
       ELSE content END AS remote,
  mtime_ms AS local_ms, {BASE} + n * 1000 + ((n % 3) - 1) * 60000 AS remote_ms
FROM (SELECT *, string_split(content, chr(10))[-1] AS last FROM v_files)""",
)
view(
    "v_local",
    "SELECT n, doc_id, path, local AS content, sha256(local) AS hash, local_ms AS mtime_ms FROM v_sides",
)
view(
    "v_remote",
    """
SELECT s.n, s.doc_id, path, remote AS content, sha256(remote) AS hash, remote_ms AS mtime_ms,
  (l.quality + 1)::INTEGER AS version FROM v_sides s JOIN labels l ON l.doc_id = s.n""",
)
view(
    "v_paired",
    """
SELECT l.doc_id, l.n, l.path, l.hash AS lh, r.hash AS rh, l.mtime_ms AS lm, r.mtime_ms AS rm, r.version AS rv,
  l.content AS lc, r.content AS rc, r.doc_id IS NOT NULL AS remote_exists,
  r.doc_id IS NOT NULL AND l.hash <> r.hash AS conflict
FROM v_local l LEFT JOIN v_remote r USING (doc_id)""",
)
view(
    "v_text",
    """
SELECT n, path, base, local, remote,
  CASE WHEN local = base THEN remote WHEN remote = base THEN local
       ELSE array_to_string(list_transform(merged, lambda m: m.t), chr(10)) END AS merged,
  CASE WHEN local = base OR remote = base THEN false
       ELSE len(list_filter(merged, lambda m: m.c)) > 0 END AS has_conflicts
FROM (SELECT *, list_transform(range(1, greatest(len(l), len(r)) + 1), lambda i:
        CASE WHEN coalesce(l[i], '') = coalesce(r[i], '') THEN {'t': coalesce(l[i], ''), 'c': false}
             WHEN coalesce(l[i], '') = coalesce(b[i], '') THEN {'t': coalesce(r[i], ''), 'c': false}
             WHEN coalesce(r[i], '') = coalesce(b[i], '') THEN {'t': coalesce(l[i], ''), 'c': false}
             ELSE {'t': '<<<<<<< LOCAL' || chr(10) || coalesce(l[i], '') || chr(10) || '=======' || chr(10) ||
                        coalesce(r[i], '') || chr(10) || '>>>>>>> REMOTE', 'c': true} END) AS merged
      FROM (SELECT *, string_split(base, chr(10)) AS b, string_split(local, chr(10)) AS l,
              string_split(remote, chr(10)) AS r FROM v_sides))""",
)
view(
    "v_versions",
    f"""
SELECT lower(path) AS doc_id, path, version, mtime_ms, sha256(content) AS hash, source, conflict, content FROM (
  SELECT lpad((conv_id % 210)::VARCHAR, 3, '0') || '/Conv-' || conv_id || '.md' AS path, turn + 1 AS version,
    {BASE} + conv_id * 60000 + turn * 1000 AS mtime_ms,
    CASE WHEN role = 'user' THEN 'local' ELSE 'remote' END AS source, role = 'system' AS conflict, text AS content
  FROM conversations)""",
)
view(
    "v_events",
    """
SELECT lpad((user_id % 230)::VARCHAR, 3, '0') || '/u' || user_id || '.md' AS path,
  CASE event_type WHEN 'signup' THEN 'add' WHEN 'error' THEN 'unlink' ELSE 'change' END AS event,
  ts, event_id AS seq, 's' || user_id AS schedule, user_id
FROM events""",
)
# Sessions: a gap of more than six hours starts a new one.
view(
    "v_bursts",
    """
SELECT path, arg_max(event, (ts, seq)) AS event, max(ts) AS last, count(*) AS events FROM (
  SELECT *, sum(starts) OVER (PARTITION BY path ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS burst FROM (
    SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY path ORDER BY ts, seq) <= INTERVAL 6 HOUR THEN 0 ELSE 1 END
      AS starts FROM v_events))
GROUP BY path, burst""",
)
# Each cron form expanded by hand; the last three have an empty list somewhere.
view(
    "v_forms",
    """
SELECT * FROM (VALUES
  (0, [0], range(0, 24), range(1, 32)),
  (1, [30], [6], range(1, 32)),
  (2, [0], range(9, 18), range(1, 32)),
  (3, [0, 15, 30, 45], [8, 20], range(1, 32)),
  (4, [5, 35], [0, 6, 12, 18], [1, 15]),
  (5, [0], [0], [31]),
  (6, [10], [12], range(1, 32)),
  (7, [0], []::BIGINT[], range(1, 32)),
  (8, []::BIGINT[], range(0, 24), range(1, 32)),
  (9, []::BIGINT[], []::BIGINT[], []::BIGINT[])) t(form, minutes, hours, days)""",
)
view(
    "v_form_runs",
    """
SELECT form, day + to_hours(h) + to_minutes(m) AS run_ts FROM (
  SELECT form, day, h, unnest(minutes) AS m FROM (
    SELECT form, minutes, day, unnest(hours) AS h FROM v_forms,
      (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-03-05', INTERVAL 1 DAY)) AS day) d
    WHERE list_contains(days, day(day))))""",
)
view(
    "v_user_schedules",
    """
SELECT user_id AS k, 's' || user_id AS name, CASE WHEN user_id % 3 = 0 THEN 'interval' ELSE 'cron' END AS type,
  CASE WHEN user_id % 3 = 0 THEN (user_id % 5 + 1) * 3 * 3600000 END AS interval_ms,
  user_id % 10 AS form, user_id % 11 <> 5 AS enabled
FROM (SELECT DISTINCT user_id FROM events)""",
)
view(
    "v_calendar",
    """
SELECT name AS schedule, run_ts FROM v_user_schedules s JOIN v_form_runs r USING (form)
WHERE type = 'cron' AND enabled AND run_ts > TIMESTAMP '2024-01-01' AND run_ts <= TIMESTAMP '2024-02-01'
UNION ALL
SELECT name, TIMESTAMP '2024-01-01' + to_milliseconds(k * interval_ms) FROM (
  SELECT name, interval_ms, unnest(range(1, 2678400000 // interval_ms + 1)) AS k FROM v_user_schedules
  WHERE type = 'interval' AND enabled)""",
)
# All five fields: form 2 fires from Monday to Friday, form 6 in February alone.
view(
    "v_long_runs",
    """
SELECT form, day + to_hours(h) + to_minutes(m) AS run_ts FROM (
  SELECT form, day, h, unnest(minutes) AS m FROM (
    SELECT form, minutes, day, unnest(hours) AS h FROM v_forms,
      (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-04-30', INTERVAL 1 DAY)) AS day) d
    WHERE list_contains(days, day(day)) AND (form <> 2 OR isodow(day) <= 5) AND (form <> 6 OR month(day) = 2)))""",
)
view(
    "v_long_calendar",
    """
SELECT name AS schedule, run_ts FROM v_user_schedules s JOIN v_long_runs r USING (form)
WHERE type = 'cron' AND enabled AND run_ts > TIMESTAMP '2024-01-01' AND run_ts <= TIMESTAMP '2024-04-30'
UNION ALL
SELECT name, TIMESTAMP '2024-01-01' + to_milliseconds(k * interval_ms) FROM (
  SELECT name, interval_ms, unnest(range(1, 10368000000 // interval_ms + 1)) AS k FROM v_user_schedules
  WHERE type = 'interval' AND enabled)""",
)
