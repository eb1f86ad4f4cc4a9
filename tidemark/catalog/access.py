"""Scopes, filters, reading, payloads and search."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog import shared_sql  # noqa: F401
from tidemark.catalog.registry import register, view
from tidemark.operators import filters as L
from tidemark.operators import postings as N
from tidemark.operators import scopes as S
from tidemark.operators import search as Q
from tidemark.plans import views as W
from tidemark.session import work_dir
from tidemark.sources import payload

_ALLOWED = "regexp_matches(lower(split_part(replace(path, '\\', '/'), '/', 1)), '^(100|101|102|103|104)')"


@register(f"SELECT n, path FROM v_files WHERE {_ALLOWED}", uses=("v_files",))
def scope_filter(spark, d):
    return S.scope_filter(W.files(spark, d)).select("n", "path")


def _nation_rules(spark, d):
    """An agent per region whose folders are two-digit prefixes made from its nations' keys."""
    n = W.read(spark, d, "nation")
    return n.select(
        F.concat(F.lit("Agent"), F.col("n_regionkey").cast("string")).alias("agent"),
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("prefix"),
    )


view(
    "v_rules",
    "SELECT 'Agent' || n_regionkey AS agent, lpad(n_nationkey::VARCHAR, 2, '0') AS prefix FROM nation",
)


@register(
    """SELECT n, path FROM v_files WHERE EXISTS (SELECT 1 FROM v_rules WHERE agent = 'Agent1'
         AND starts_with(split_part(path, '/', 1), prefix))""",
    uses=("v_files", "v_rules"),
)
def scope_filter_table(spark, d):
    return S.scope_filter(W.files(spark, d), _nation_rules(spark, d), "Agent1").select("n", "path")


@register(
    f"""SELECT n, {_ALLOWED} AS allowed, CASE WHEN {_ALLOWED} THEN split_part(path, '/', 1) END AS scope,
         CASE WHEN NOT {_ALLOWED} THEN 'path not allowed' END AS reason FROM v_files""",
    uses=("v_files",),
)
def scope_verdict(spark, d):
    return S.scope_verdict(W.files(spark, d)).select("n", "allowed", "scope", "reason")


@register(
    """SELECT n, ok AS allowed, CASE WHEN ok THEN split_part(path, '/', 1) END AS scope,
         CASE WHEN NOT ok THEN 'path not allowed' END AS reason
       FROM (SELECT n, path, EXISTS (SELECT 1 FROM v_rules WHERE agent = 'Agent2'
         AND starts_with(split_part(path, '/', 1), prefix)) AS ok FROM v_files)
       UNION ALL
       SELECT -1 - n, false, NULL, 'unknown agent' FROM v_files""",
    uses=("v_files", "v_rules"),
)
def scope_verdict_table(spark, d):
    files, rules = W.files(spark, d), _nation_rules(spark, d)
    known = S.scope_verdict(files, rules, "Agent2")
    unknown = S.scope_verdict(files.withColumn("n", -1 - F.col("n")), rules, "nobody")
    return known.unionByName(unknown).select("n", "allowed", "scope", "reason")


# Prefixes inside each other and of every length, for agents of all sizes; each supplier is an agent with one folder.
view(
    "v_many_rules",
    """SELECT agent, prefix FROM v_rules UNION ALL SELECT 'all', '' UNION ALL SELECT 'nobody', NULL
       UNION ALL SELECT 'Hundred' || r_regionkey, r_regionkey::VARCHAR FROM region
       UNION ALL SELECT 'Supplier' || s_suppkey, lpad((s_suppkey % 300)::VARCHAR, 3, '0') FROM supplier""",
)


@register(
    """SELECT n, agent, split_part(path, '/', 1) AS scope FROM v_files
       JOIN (SELECT DISTINCT agent, prefix FROM v_many_rules) ON starts_with(split_part(path, '/', 1), prefix) GROUP BY ALL""",
    uses=("v_files", "v_many_rules"),
)
def scope_matrix(spark, d):
    """Which of all agents may see each file."""
    text = lambda name: F.col(name).cast("string")
    named = lambda head, key: F.concat(F.lit(head), text(key)).alias("agent")
    regions = W.read(spark, d, "region").select(named("Hundred", "r_regionkey"), text("r_regionkey").alias("prefix"))
    suppliers = W.read(spark, d, "supplier").select(
        named("Supplier", "s_suppkey"), F.lpad((F.col("s_suppkey") % 300).cast("string"), 3, "0").alias("prefix"))
    ends = S.scopes_table(spark, {"all": [""], "nobody": []})
    rules = _nation_rules(spark, d).unionByName(ends).unionByName(regions).unionByName(suppliers)
    return S.scope_matrix(W.files(spark, d), rules).select("n", "agent", "scope")


@register(
    """SELECT agent, prefix FROM v_rules WHERE agent NOT IN (SELECT 'Agent' || r_regionkey FROM region WHERE r_name = 'ASIA')
       UNION ALL SELECT 'Agent' || r_regionkey, lower(r_name) FROM region WHERE r_name = 'ASIA'""",
    uses=("v_rules",),
)
def effective_scopes(spark, d):
    custom = W.read(spark, d, "region").filter(F.col("r_name") == "ASIA").select(
        F.concat(F.lit("Agent"), F.col("r_regionkey").cast("string")).alias("agent"), F.lower("r_name").alias("prefix")
    )
    return S.effective_scopes(_nation_rules(spark, d), custom)


@register(
    "SELECT n, regexp_matches(path, '[.](png|jpg|jpeg|pdf|zip|7z|rar|mp4|mov|avi)$', 'i') AS is_binary FROM v_files",
    uses=("v_files",),
)
def with_is_binary(spark, d):
    return L.with_is_binary(W.files(spark, d)).select("n", "is_binary")


# One path form per remainder of the document number.
_ODD_PATHS = ("", "_design/x", "../up", "/abs/x", "a/../../b", "a/../b", "C:\\x", "ok\\sub\\x", "a/./b/..", "..")


def _odd_paths(spark, d):
    n = F.col("n")
    form = F.element_at(F.array(*[F.lit(p) for p in _ODD_PATHS]), (n % 10 + 1).cast("int"))
    odd = F.when(n % 3 == 0, F.col("path")).otherwise(form)
    return W.files(spark, d).select("n", "doc_id", odd.alias("path"))


view(
    "v_odd",
    """SELECT n, doc_id, CASE WHEN n % 3 = 0 THEN path ELSE (['', '_design/x', '../up', '/abs/x', 'a/../../b', 'a/../b', 'C:\\x',
         'ok\\sub\\x', 'a/./b/..', '..'])[n % 10 + 1] END AS path FROM v_files""",
)


@register(
    """SELECT n FROM (SELECT n, coalesce(nullif(path, ''), doc_id) AS p,
         list_transform(string_split(replace(coalesce(nullif(path, ''), doc_id), '\\', '/'), '/'),
           lambda s: CASE WHEN s IN ('', '.') THEN 0 WHEN s = '..' THEN -1 ELSE 1 END) AS steps FROM v_odd)
       WHERE NOT starts_with(p, '_') AND NOT starts_with(p, '/') AND NOT regexp_matches(p, '^[A-Za-z]:')
         AND list_min(list_transform(range(1, len(steps) + 1), lambda i: list_sum(steps[1:i]))) >= 0""",
    uses=("v_odd",),
)
def valid_paths(spark, d):
    return L.valid_paths(_odd_paths(spark, d)).select("n")


# One path form per remainder of the page number.
_IGNORABLE = (
    "100/a.md", "100/node_modules/x.js", "100/.git/config", "dist/a.md", "100/build/x", "100/a.tmp", ".env", "100/.hid/a.md",
    "100/distance/a.md",
)


@register(
    """SELECT page_id, path FROM (SELECT page_id, (['100/a.md', '100/node_modules/x.js', '100/.git/config', 'dist/a.md',
         '100/build/x', '100/a.tmp', '.env', '100/.hid/a.md', '100/distance/a.md'])[page_id % 9 + 1] AS path FROM pages)
       WHERE NOT list_has_any(string_split(path, '/'), ['node_modules', '.git', 'dist', 'build', '.env'])
         AND NOT ends_with(path, '.tmp') AND NOT regexp_matches(path, '(^|/)[.]')"""
)
def ignore_filter(spark, d):
    form = F.element_at(F.array(*[F.lit(p) for p in _IGNORABLE]), (F.col("page_id") % 9 + 1).cast("int"))
    return L.ignore_filter(W.read(spark, d, "pages").select("page_id", form.alias("path")))


@register("SELECT page_id, url FROM pages WHERE starts_with(url, 'https://m.')")
def prefix_filter(spark, d):
    return L.prefix_filter(W.read(spark, d, "pages"), "https://m.", "url").select("page_id", "url")


@register(
    "SELECT n, path FROM v_files WHERE split_part(path, '/', 1) IN ('100', '101', '102', '103', '104')",
    uses=("v_files",),
)
def watched_filter(spark, d):
    return L.watched_filter(W.files(spark, d)).select("n", "path")


_TOXIC = "n IN (SELECT doc_id FROM labels WHERE toxic = 1)"


@register(
    f"""SELECT doc_id FROM v_files WHERE NOT {_TOXIC} UNION ALL SELECT DISTINCT chunk_id FROM v_chunks
        UNION ALL SELECT 'page-' || page_id FROM pages""",
    uses=("v_chunks",),
)
def live_docs(spark, d):
    return L.live_docs(W.mixed_docs(spark, d)).select("doc_id")


@register(f"SELECT path FROM v_files WHERE {_TOXIC}", uses=("v_files",))
def tombstones(spark, d):
    return L.tombstones(W.mixed_docs(spark, d))


@register(
    f"""SELECT path, b AS binary, CASE WHEN NOT b THEN sha256(content) END AS hash,
         octet_length(encode(content))::BIGINT AS size_bytes,
         CASE WHEN NOT b THEN strftime(make_timestamp(mtime_ms * 1000), '%Y-%m-%dT%H:%M:%S.000Z') END AS modified_at
       FROM (SELECT *, n % 4 = 3 AS b FROM v_files WHERE {_ALLOWED})""",
    uses=("v_files",),
)
def read_files(spark, d):
    return L.read_files(W.files(spark, d)).withColumn("hash", F.sha2("content", 256)).drop("content")


# Payload prefixes in order of the remainder; the last gives an empty payload.
_PREFIXES = ("%=", "%$", "", "%", "%%=")


@register(
    """SELECT n, CASE WHEN n % 6 = 5 THEN 'empty' ELSE (['static', 'ephemeral', 'plain', 'undecodable', 'undecodable'])[n % 6 + 1] END
         AS payload_kind FROM v_files""",
    uses=("v_files",),
)
def payload_kind(spark, d):
    form = F.col("n") % 6
    prefix = F.get(F.array(*[F.lit(p) for p in _PREFIXES]), form)
    coded = W.files(spark, d).withColumn("data", F.coalesce(F.concat(prefix, F.lit("x"), "content"), F.lit("")))
    return payload.payload_kind(coded).select("n", "payload_kind")


_KEYS = (b"0123456789abcdef", b"fedcba9876543210", b"00112233445566778899aabbccddeeff")


@register(
    "SELECT n, CASE WHEN n % 3 < 2 THEN sha256(content) END AS hash FROM v_files", uses=("v_files",)
)
def decrypt_col(spark, d):
    """Texts are locked under three keys in turn and opened with a ring that lacks the third."""
    n = F.col("n")
    f = W.files(spark, d).select("n", "content")
    locked = f
    for i, key in enumerate(_KEYS):
        locked = payload.encrypt_col(locked.withColumn(f"c{i}", F.when(n % 3 == i, F.col("content"))), f"c{i}", key)
    locked = locked.select("n", F.coalesce("c0", "c1", "c2").alias("data"))
    return payload.decrypt_col(locked, "data", [_KEYS[1], _KEYS[0], _KEYS[1]]).select("n", F.sha2("data", 256).alias("hash"))


view(
    "v_hits",
    """SELECT path, list_filter(list_transform(range(1, len(lines) + 1), lambda i: {'line': i, 'text': lines[i]}),
         lambda h: contains(lower(h.text), 'tion')) AS hits
       FROM (SELECT path, string_split(content, chr(10)) AS lines FROM v_files WHERE n % 4 < 3)""",
)
_SHOWN = "array_to_string(list_transform({0}, lambda h: h.line || ':' || h.text), chr(10)) AS matches"


def _shown(hits, *keys):
    text = F.array_join(
        F.transform("matches", lambda h: F.concat(h["line"].cast("string"), F.lit(":"), h["text"])), "\n"
    )
    return hits.select(*(keys or ("path",)), text.alias("matches"))


@register(
    f"SELECT path, {_SHOWN.format('hits[1:5]')} FROM v_hits WHERE len(hits) > 0 AND {_ALLOWED} ORDER BY path LIMIT 20",
    uses=("v_hits",),
)
def search(spark, d):
    return _shown(Q.search(W.files(spark, d), "Tion"))


@register(
    f"SELECT path, {_SHOWN.format('hits')} FROM v_hits WHERE len(hits) > 0",
    uses=("v_hits",),
)
def search_all(spark, d):
    return _shown(Q.search_all(W.files(spark, d), "TION", enforce=False, max_lines=None))


@register(
    "SELECT count(*) AS total_files, sum(len(hits))::BIGINT AS total_lines FROM v_hits WHERE len(hits) > 0",
    uses=("v_hits",),
)
def search_total(spark, d):
    return Q.search_total(W.files(spark, d), "tion", enforce=False)


_SHORT = "SELECT 'r' || r_regionkey AS query_id, left(r_name, 2) AS query FROM region"

view(
    "v_queries",
    f"""SELECT item_id || ':' || i AS query_id, lines[i] AS query FROM (SELECT item_id, string_split(text, chr(10)) AS lines FROM benchmark),
         LATERAL (SELECT unnest(range(1, len(lines) + 1)) AS i) UNION ALL {_SHORT}""",
)


@register(
    f"""SELECT query_id, path, {_SHOWN.format('hits')} FROM (SELECT query_id, path,
           list_filter(list_transform(range(1, len(lines) + 1), lambda i: {{'line': i, 'text': lines[i]}}),
             lambda h: contains(lower(h.text), lower(query)))[1:5] AS hits
         FROM (SELECT path, content, string_split(content, chr(10)) AS lines FROM v_files WHERE n % 4 < 3)
         JOIN v_queries ON trim(query) <> '' AND contains(lower(content), lower(query)))""",
    uses=("v_files", "v_queries"),
)
def search_many(spark, d):
    """Every line of the benchmark, and two letters of each region, looked up in an index of the files."""
    out = work_dir(spark, "postings")
    N.write_index(W.files(spark, d), out)
    items = W.read(spark, d, "benchmark").select("item_id", F.posexplode(F.split("text", "\n")).alias("i", "query"))
    lines = items.select(F.concat_ws(":", "item_id", F.col("i") + 1).alias("query_id"), "query")
    short = W.read(spark, d, "region").select(F.concat(F.lit("r"), "r_regionkey").alias("query_id"), F.left("r_name", F.lit(2)).alias("query"))
    hits = N.search_many(*N.read_index(spark, out), lines.unionByName(short), enforce=False)
    return _shown(hits, "query_id", "path")


# Real page addresses as paths: without the scheme and with dotted and named folders as they come.
view("v_urls", "SELECT page_id, regexp_replace(url, '^[a-z]+://', '') AS path FROM pages")


def _url_paths(spark, d):
    return W.read(spark, d, "pages").select("page_id", F.regexp_replace("url", "^[a-z]+://", "").alias("path"))


@register(
    """SELECT page_id, path FROM v_urls
       WHERE NOT list_has_any(string_split(path, '/'), ['node_modules', '.git', '.obsidian', 'dist', 'build', '.env'])
         AND NOT ends_with(path, '.tmp') AND NOT regexp_matches(path, '(^|/)[.]')""",
    uses=("v_urls",),
)
def ignore_filter_urls(spark, d):
    return L.ignore_filter(_url_paths(spark, d))


@register(
    """SELECT page_id FROM (SELECT page_id, path, list_transform(string_split(replace(path, '\\', '/'), '/'),
         lambda s: CASE WHEN s IN ('', '.') THEN 0 WHEN s = '..' THEN -1 ELSE 1 END) AS steps FROM v_urls)
       WHERE path <> '' AND NOT starts_with(path, '_') AND NOT starts_with(path, '/') AND NOT regexp_matches(path, '^[A-Za-z]:')
         AND list_min(list_transform(range(1, len(steps) + 1), lambda i: list_sum(steps[1:i]))) >= 0""",
    uses=("v_urls",),
)
def valid_paths_urls(spark, d):
    return L.valid_paths(_url_paths(spark, d)).select("page_id")
