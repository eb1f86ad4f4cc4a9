"""Text, Markdown and JSON merges, and the sync that uses them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog import shared_sql  # noqa: F401
from tidemark.catalog.registry import register, view
from tidemark.operators import chunks as C
from tidemark.operators import merge as M
from tidemark.operators import merge_json as J
from tidemark.operators import versions as V
from tidemark.plans import pipelines
from tidemark.plans import views as W


@register("SELECT n, sha256(merged) AS hash, has_conflicts FROM v_text", uses=("v_text",))
def merge_text(spark, d):
    return M.merge_text(W.merge_sides(spark, d)).select("n", F.sha2("merged", 256).alias("hash"), "has_conflicts")


view(
    "v_heads",
    """SELECT s.n, s.path, s.base AS bbody, s.local AS lbody, s.remote AS rbody, d.source, d.lang,
         CASE WHEN n % 5 = 0 THEN 'http://x/' || n END AS link,
         CASE WHEN n % 2 = 0 THEN 'my ' || d.source ELSE d.source END AS mine,
         CASE WHEN n % 3 = 0 THEN 'their ' || d.source ELSE d.source END AS theirs
       FROM v_sides s JOIN documents d ON d.doc_id = s.n""",
)


@register(
    """SELECT n, 'title' AS key, source AS value FROM v_heads UNION ALL SELECT n, 'lang', lang FROM v_heads
       UNION ALL SELECT n, 'link', link FROM v_heads WHERE link IS NOT NULL""",
    uses=("v_heads",),
)
def extract_frontmatter(spark, d):
    return M.frontmatter_rows(W.front_matter_sides(spark, d), "base", "n")


# The title goes to remote where local left it alone; the language changed remotely; the link that
# both sides dropped survives from the base; the two new keys come last.
view(
    "v_front",
    """SELECT n, CASE WHEN mine = source THEN theirs ELSE mine END AS title, 'xx' AS lang, link, n::VARCHAR AS added,
         'a: b' AS title2 FROM v_heads""",
)


@register(
    """SELECT n, 0::INTEGER AS pos, 'title' AS key, title AS value FROM v_front
       UNION ALL SELECT n, 1, 'lang', lang FROM v_front UNION ALL SELECT n, 2, 'link', link FROM v_front WHERE link IS NOT NULL
       UNION ALL SELECT n, CASE WHEN link IS NULL THEN 2 ELSE 3 END, 'added', added FROM v_front
       UNION ALL SELECT n, CASE WHEN link IS NULL THEN 3 ELSE 4 END, 'title2', title2 FROM v_front""",
    uses=("v_front",),
)
def merge_frontmatter(spark, d):
    return M.merge_frontmatter(W.front_matter_sides(spark, d), "n")


# The bodies are the merge sides of the text query, so their merge is known already.
view(
    "v_markdown",
    """SELECT n, path, '---' || chr(10) || 'title: ' || title || chr(10) || 'lang: xx' || chr(10) ||
         coalesce('link: ' || link || chr(10), '') || 'added: ' || added || chr(10) || 'title2: a: b' || chr(10) ||
         '---' || chr(10) || chr(10) || merged AS merged, has_conflicts
       FROM v_front JOIN v_text USING (n)""",
)


@register("SELECT n, sha256(merged) AS hash, has_conflicts FROM v_markdown", uses=("v_markdown",))
def merge_markdown(spark, d):
    sides = W.front_matter_sides(spark, d)
    return M.merge_markdown(sides).select("n", F.sha2("merged", 256).alias("hash"), "has_conflicts")


# Orders as JSON with their customer, merged by hand: local changes the status of every second order,
# remote of every third; remote alone moves the segment of every fourth.
view(
    "v_orders",
    """SELECT o_orderkey AS k, o_custkey AS cust, c_name AS name, o_orderpriority AS prio, o_orderstatus AS st,
         c_mktsegment AS seg,
         CASE WHEN o_orderkey % 2 = 0 THEN 'L' ELSE o_orderstatus END AS ls,
         CASE WHEN o_orderkey % 3 = 0 THEN 'R' ELSE o_orderstatus END AS rs,
         CASE WHEN o_orderkey % 4 = 0 THEN 'moved' ELSE c_mktsegment END AS rseg
       FROM orders LEFT JOIN customer ON c_custkey = o_custkey""",
)


def _pretty(status: str, segment: str) -> str:
    lines = [
        "'{'", "'  \"cust\": ' || cust || ','", f"'  \"status\": \"' || {status} || '\",'", "'  \"customer\": {'",
        "'    \"name\": \"' || name || '\",'", f"'    \"segment\": \"' || {segment} || '\"'", "'  },'", "'  \"tags\": ['",
        "'    \"' || st || '\",'", "'    \"' || prio || '\",'", "'    \"new\"'", "'  ],'", "'  \"mine\": ' || k || ','",
        "'  \"theirs\": ' || k", "'}'",
    ]
    return " || chr(10) || ".join(f"({line})" for line in lines)


@register(
    f"""SELECT k AS o_orderkey, {_pretty("CASE WHEN ls <> st THEN ls ELSE rs END", "rseg")} AS merged,
          CASE WHEN ls <> st AND rs <> st THEN 'status: local=L, remote=R, base=' || st ELSE '' END AS conflicts,
          ls <> st AND rs <> st AS has_conflicts FROM v_orders""",
    uses=("v_orders",),
)
def merge_json(spark, d):
    out = J.merge_json(W.json_sides(spark, d))
    return out.select("o_orderkey", "merged", F.array_join("conflicts", ";").alias("conflicts"), "has_conflicts")


@register(
    f"""SELECT k AS o_orderkey, {_pretty("rs", "rseg")} AS merged,
          concat_ws(';', CASE WHEN ls <> rs THEN 'status: local=' || ls || ', remote=' || rs END,
            CASE WHEN seg <> rseg THEN 'customer.segment: local=' || seg || ', remote=' || rseg END) AS conflicts,
          ls <> rs OR seg <> rseg AS has_conflicts FROM v_orders""",
    uses=("v_orders",),
)
def merge_json_two_way(spark, d):
    out = J.merge_json(W.json_sides(spark, d), prefer_remote=True, with_base=False)
    return out.select("o_orderkey", "merged", F.array_join("conflicts", ";").alias("conflicts"), "has_conflicts")


@register(
    """SELECT k AS o_orderkey, json_path, value, conflict FROM v_orders, LATERAL (VALUES
         ('cust', cust::DOUBLE::VARCHAR, false), ('status', '"' || ls || '"', ls <> rs),
         ('customer.name', '"' || name || '"', false), ('customer.segment', '"' || seg || '"', seg <> rseg),
         ('tags', '["' || st || '","' || prio || '","new"]', false),
         ('mine', k::DOUBLE::VARCHAR, false), ('theirs', k::DOUBLE::VARCHAR, false)) t(json_path, value, conflict)""",
    uses=("v_orders",),
)
def merge_json_leaves(spark, d):
    sides = W.json_sides(spark, d)
    depth = J.json_depth(sides, "local", "remote")
    local, remote = [J.json_leaves(sides, "o_orderkey", side, depth) for side in ("local", "remote")]
    return J.merge_json_leaves(local, remote, "o_orderkey")


@register(
    """SELECT event_id, 'k' AS json_path, 'number' AS kind, (props ->> 'k')::DOUBLE::VARCHAR AS value FROM events"""
)
def json_leaves(spark, d):
    return J.json_leaves(W.read(spark, d, "events").select("event_id", "props"), "event_id", "props")


def _routed(spark, d, *kept):
    """Markdown with front matter, JSON for half the `.json` files, prose for the others; `kept` names further columns of the sides."""
    sides = W.merge_sides(spark, d)
    heads = W.front_matter_sides(spark, d, *kept)
    n = F.col("n")
    is_md, is_json = n % 4 == 0, n % 8 == 2

    def json_doc(side, shared):
        return F.to_json(F.struct(n.alias("n"), shared.alias("who"), F.array(F.lit(side)).alias("tags")))

    plain = sides.filter(~is_md).select(
        "n", "path", *kept,
        *[
            F.when(is_json, json_doc(c, F.when(n % 3 == 0, F.lit(c)).otherwise(F.lit("same")))).otherwise(F.col(c)).alias(c)
            for c in ("base", "local", "remote")
        ],
    )
    return heads.filter(is_md).unionByName(plain)


_JSON_TEXT = """'{' || chr(10) || '  "n": ' || n || ',' || chr(10) || '  "who": "' ||
  CASE WHEN n % 3 = 0 THEN 'local' ELSE 'same' END || '",' || chr(10) || '  "tags": [' || chr(10) || '    "local",' || chr(10) ||
  '    "remote"' || chr(10) || '  ]' || chr(10) || '}'"""


@register(
    f"""SELECT n, sha256(CASE WHEN n % 4 = 0 THEN m.merged WHEN n % 8 = 2 THEN {_JSON_TEXT} ELSE t.merged END) AS hash,
          CASE WHEN n % 4 = 0 THEN m.has_conflicts WHEN n % 8 = 2 THEN n % 3 = 0 ELSE t.has_conflicts END AS has_conflicts
        FROM v_text t JOIN v_markdown m USING (n)""",
    uses=("v_markdown", "v_text"),
)
def merge_conflicts(spark, d):
    return M.merge_conflicts(_routed(spark, d)).select("n", F.sha2("merged", 256).alias("hash"), "has_conflicts")


view(
    "v_synced",
    """SELECT p.doc_id, p.n, conflict, remote_exists, lc, rc, lm, rm, rh, rv, t.merged, t.has_conflicts,
         CASE WHEN NOT remote_exists THEN 'new' WHEN NOT conflict THEN 'unchanged'
              WHEN NOT t.has_conflicts THEN 'merged' WHEN rm > lm THEN 'remote' ELSE 'local' END AS outcome
       FROM v_paired p JOIN v_text t USING (n)""",
)


@register(
    """SELECT doc_id, outcome, sha256(CASE outcome WHEN 'merged' THEN merged WHEN 'remote' THEN rc ELSE lc END) AS hash,
         (coalesce(rv, 0) + CASE outcome WHEN 'remote' THEN 0 ELSE 1 END)::INTEGER AS version,
         CASE outcome WHEN 'remote' THEN rm ELSE lm END AS mtime_ms,
         CASE WHEN conflict AND outcome <> 'remote' THEN rv || ':' || rh ELSE '' END AS versions
       FROM v_synced""",
    uses=("v_synced",),
)
def sync_with_merge(spark, d):
    """All files take part; JSON files hold prose, so they merge as text, and no text has front matter."""
    local, remote = W.replicas(spark, d)
    base = W.merge_sides(spark, d).select("doc_id", F.col("base").alias("content"))
    out = pipelines.sync_with_merge(local, remote, base, chunk_bytes=W.CHUNK)
    history = F.transform("versions", lambda v: F.concat_ws(":", v["version"].cast("string"), v["hash"]))
    return out.select(
        "doc_id", "outcome", "hash", "version", F.unix_millis("mtime").alias("mtime_ms"),
        F.array_join(history, ",").alias("versions"),
    )


@register(
    """SELECT doc_id, outcome, sha256(CASE outcome WHEN 'merged' THEN merged WHEN 'remote' THEN rc ELSE lc END) AS hash,
         (coalesce(rv, 0) + CASE outcome WHEN 'remote' THEN 0 ELSE 1 END)::INTEGER AS version, path
       FROM v_synced s JOIN (SELECT n, path FROM v_files) USING (n)""",
    uses=("v_synced", "v_files"),
)
def sync_case_variants(spark, d):
    """Every file and every remote document has an older variant whose path differs in case: one answer for each key."""
    local, remote = W.replicas(spark, d)
    day = F.expr("INTERVAL 1 DAY")
    stale = {"path": F.upper("path"), "content": F.lit("stale"), "hash": F.sha2(F.lit("stale"), 256), "mtime": F.col("mtime") - day}
    base = W.merge_sides(spark, d).select("doc_id", F.col("base").alias("content"), F.col("local_mtime").alias("mtime"))
    older = base.withColumns({"content": F.lit("stale"), "mtime": F.col("mtime") - day})
    out = pipelines.sync_with_merge(
        local.unionByName(local.withColumns(stale)), remote.unionByName(remote.withColumns(stale | {"version": F.lit(9)})),
        base.unionByName(older), chunk_bytes=W.CHUNK,
    )
    return out.select("doc_id", "outcome", "hash", "version", "path")


@register(
    r"""SELECT k AS o_orderkey, json_path, value, conflict FROM v_orders, LATERAL (VALUES
         ('a\.b', '"' || ls || '"', ls <> rs), ('a.b', '"' || seg || '"', seg <> rseg), ('c\\d.', k::DOUBLE::VARCHAR, false)) t(json_path, value, conflict)""",
    uses=("v_orders",),
)
def merge_json_leaves_dotted(spark, d):
    """Keys with dots and backslashes beside nested keys that read alike."""
    sides = W.json_sides(spark, d)

    def doc(side):
        own = F.get_json_object(side, "$.status").alias("a.b")
        return F.to_json(F.struct(own, F.struct(F.get_json_object(side, "$.customer.segment").alias("b")).alias("a"), F.struct(F.col("o_orderkey").alias("")).alias("c\\d")))

    texts = sides.select("o_orderkey", doc("local").alias("local"), doc("remote").alias("remote"))
    depth = J.json_depth(texts, "local", "remote")
    local, remote = [J.json_leaves(texts, "o_orderkey", side, depth) for side in ("local", "remote")]
    return J.merge_json_leaves(local, remote, "o_orderkey")


def _deep(spark, d):
    """Orders eight objects deep: the sides differ in the innermost status and in keys that only one side has."""
    sides = W.json_sides(spark, d)

    def nested(side):
        text = F.get_json_object(side, "$.status")
        inner = F.concat(F.lit('{"status":"'), text, F.lit(f'","only_{side}":{{"x":1}}}}'))
        for level in "gfedcba":
            inner = F.concat(F.lit('{"' + level + '":'), inner, F.lit("}"))
        return inner.alias(side)

    return sides.select("o_orderkey", nested("local"), nested("remote"))


@register(
    """SELECT k AS o_orderkey, 'a.b.c.d.e.f.g.' || leaf AS json_path, value, conflict FROM v_orders, LATERAL (VALUES
         ('status', '"' || ls || '"', ls <> rs), ('only_local.x', '1.0', false), ('only_remote.x', '1.0', false)) t(leaf, value, conflict)""",
    uses=("v_orders",),
)
def merge_json_leaves_deep(spark, d):
    sides = _deep(spark, d)
    depth = J.json_depth(sides, "local", "remote")
    local, remote = [J.json_leaves(sides, "o_orderkey", side, depth) for side in ("local", "remote")]
    return J.merge_json_leaves(local, remote, "o_orderkey")


@register(
    """SELECT k AS o_orderkey, CASE WHEN ls <> rs THEN 'a.b.c.d.e.f.g.status: local=' || ls || ', remote=' || rs ELSE '' END AS conflicts
       FROM v_orders""",
    uses=("v_orders",),
)
def merge_json_deep(spark, d):
    return J.merge_json(_deep(spark, d)).select("o_orderkey", F.array_join("conflicts", ";").alias("conflicts"))


# ---- a whole sync: Markdown with front matter, JSON and prose, over a remote side and a real base ----

SYNC_RULES = {"assistant": ("0", "1")}


def _head(title: str, lang: str, extra: str) -> str:
    return f"'---' || chr(10) || 'title: ' || {title} || chr(10) || 'lang : ' || {lang} || chr(10) || 'no colon here' || chr(10) || {extra} || '---' || chr(10)"


def _side_sql(side: str, head: str, who: str) -> str:
    return f"""CASE WHEN s.n % 4 = 0 THEN {head} || s.{side}
      WHEN s.n % 8 = 2 THEN '{{"n":' || s.n || ',"who":"' || CASE WHEN s.n % 3 = 0 THEN '{who}' ELSE 'same' END || '","tags":["{side}"]}}'
      ELSE s.{side} END"""


view(
    "v_whole",
    f"""
SELECT *, CASE WHEN rv IS NULL THEN 'new' WHEN sha256(local) = sha256(remote) THEN 'unchanged' WHEN NOT has_conflicts THEN 'merged'
    WHEN rm > lm THEN 'remote' ELSE 'local' END AS outcome
FROM (SELECT s.n, s.doc_id, s.path, s.local_ms AS lm, s.remote_ms AS rm, (l.quality + 1)::INTEGER AS rv,
    {_side_sql("local", _head("h.mine", "h.lang", "''"), "local")} AS local,
    {_side_sql("remote", _head("h.theirs", "'xx'", "'added: ' || s.n || chr(10) || 'title2: a: b' || chr(10)"), "remote")} AS remote,
    CASE WHEN s.n % 4 = 0 THEN m.merged WHEN s.n % 8 = 2 THEN {_JSON_TEXT.replace("|| n ||", "|| s.n ||").replace("WHEN n %", "WHEN s.n %")} ELSE t.merged END AS merged,
    CASE WHEN s.n % 4 = 0 THEN m.has_conflicts WHEN s.n % 8 = 2 THEN s.n % 3 = 0 ELSE t.has_conflicts END AS has_conflicts
  FROM v_sides s JOIN v_heads h USING (n) JOIN v_text t USING (n) JOIN v_markdown m USING (n) LEFT JOIN labels l ON l.doc_id = s.n
  WHERE left(s.path, 1) IN ('0', '1'))""",
)
view(
    "v_whole_final",
    """SELECT *, CASE outcome WHEN 'merged' THEN merged WHEN 'remote' THEN remote ELSE local END AS content,
         (coalesce(rv, 0) + CASE outcome WHEN 'remote' THEN 0 ELSE 1 END)::INTEGER AS version FROM v_whole""",
)


def _pieces_sql(source: str, content: str) -> str:
    return f"""SELECT n, doc_id, pos, sha256(array_slice(raw, pos * 1024 + 1, (pos + 1) * 1024)) AS chunk_id,
      octet_length(array_slice(raw, pos * 1024 + 1, (pos + 1) * 1024))::BIGINT AS bytes
    FROM (SELECT n, doc_id, encode({content}) AS raw, unnest(range(greatest((octet_length(encode({content})) + 1023) // 1024, 1))) AS pos
      FROM {source})"""


view("v_whole_chunks", _pieces_sql("v_whole_final", "content"))
view("v_whole_stored", _pieces_sql("(SELECT * FROM v_whole WHERE rv IS NOT NULL)", "remote"))
# The store holds the chunks of documents out of scope too.
view(
    "v_stored_all",
    _pieces_sql(
        f"""(SELECT s.n, s.doc_id, {_side_sql("remote", _head("h.theirs", "'xx'", "'added: ' || s.n || chr(10) || 'title2: a: b' || chr(10)"), "remote")} AS remote
        FROM v_sides s JOIN v_heads h USING (n) JOIN labels l ON l.doc_id = s.n)""",
        "remote",
    ),
)


def _sync(spark, d):
    """Remote documents (of all labelled files) with their chunks, and what a sync of all files over them writes."""
    sides = _routed(spark, d, "doc_id", "local_mtime", "remote_mtime")
    local = sides.select("doc_id", "path", F.col("local").alias("content"), F.col("local_mtime").alias("mtime"))
    labels = W.read(spark, d, "labels").select(F.col("doc_id").alias("n"), (F.col("quality") + 1).cast("int").alias("version"))
    texts = sides.join(labels, "n").select("doc_id", "path", F.col("remote").alias("content"), F.col("remote_mtime").alias("mtime"), "version")
    remote = texts.select(
        "*", C.child_ids(F.col("content"), W.CHUNK).alias("children"), F.sha2(F.col("content").cast("binary"), 256).alias("hash")
    )
    held = C.with_chunk_id(C.chunk_files(remote, W.CHUNK)).select("chunk_id", "data").dropDuplicates(["chunk_id"])
    base = sides.select("doc_id", F.col("base").alias("content"))
    return remote, held, pipelines.sync(local, remote, base, held, SYNC_RULES, chunk_bytes=W.CHUNK)


@register(
    """SELECT f.doc_id, outcome, sha256(content) AS hash, version, CASE outcome WHEN 'remote' THEN rm ELSE lm END AS mtime_ms,
         CASE WHEN outcome IN ('merged', 'local') THEN rv || ':' || sha256(remote) ELSE '' END AS versions, children
       FROM v_whole_final f JOIN (SELECT doc_id, string_agg(chunk_id, ',' ORDER BY pos) AS children FROM v_whole_chunks GROUP BY doc_id) USING (doc_id)""",
    uses=("v_whole_final", "v_whole_chunks"),
)
def sync_documents(spark, d):
    history = F.transform("versions", lambda v: F.concat_ws(":", v["version"].cast("string"), v["hash"]))
    return _sync(spark, d)[2].documents.select(
        "doc_id", "outcome", "hash", "version", F.unix_millis("mtime").alias("mtime_ms"),
        F.array_join(history, ",").alias("versions"), F.array_join("children", ",").alias("children"),
    )


@register(
    """SELECT chunk_id, max(bytes) AS bytes FROM v_whole_chunks JOIN v_whole USING (doc_id)
       WHERE outcome IN ('new', 'merged', 'local') AND chunk_id NOT IN (SELECT chunk_id FROM v_stored_all) GROUP BY chunk_id""",
    uses=("v_whole_chunks", "v_whole", "v_stored_all"),
)
def sync_chunks(spark, d):
    return _sync(spark, d)[2].chunks.select("chunk_id", F.octet_length("data").cast("long").alias("bytes"))


@register(
    """SELECT doc_id || '.v' || rv AS doc_id, sha256(remote) AS hash, rv AS version, true AS archived, children FROM v_whole
       JOIN (SELECT doc_id, string_agg(chunk_id, ',' ORDER BY pos) AS children FROM v_whole_stored GROUP BY doc_id) USING (doc_id)
       WHERE outcome IN ('merged', 'local')""",
    uses=("v_whole", "v_whole_stored"),
)
def sync_archives(spark, d):
    return _sync(spark, d)[2].archives.select("doc_id", "hash", "version", "archived", F.array_join("children", ",").alias("children"))


@register(
    f"""SELECT path, CASE WHEN left(path, 1) IN ('0', '1') THEN 'success' ELSE 'error' END AS status,
          CASE WHEN left(path, 1) IN ('0', '1') THEN 'synced: ' || outcome ELSE 'path not allowed' END AS message,
          split_part(path, '/', 1) AS scope FROM v_sides LEFT JOIN (SELECT n, outcome FROM v_whole) USING (n)""",
    uses=("v_sides", "v_whole"),
)
def sync_audit(spark, d):
    return _sync(spark, d)[2].audit.select("path", "status", "message", "scope")


@register(
    """SELECT doc_id, sha256(remote) AS hash, (rv + 2)::INTEGER AS version, rv AS reverted_from FROM v_whole WHERE outcome IN ('merged', 'local')""",
    uses=("v_whole",),
)
def sync_then_revert(spark, d):
    """Every document whose remote version a sync has overwritten, set back to that version."""
    done = _sync(spark, d)[2]
    columns = ["doc_id", "path", "children", "hash", "mtime", "version", "archived"]
    store = done.documents.withColumn("archived", F.lit(False)).select(columns).unionByName(done.archives.select(columns))
    wanted = done.documents.filter(F.size("versions") > 0).select("path", F.element_at("versions", -1)["version"].alias("to_version"))
    back = V.revert_to(store, wanted, W.END_MS, SYNC_RULES)
    return back.select("doc_id", "hash", "version", "reverted_from")


@register(
    "SELECT doc_id, sha256(content) AS hash, 0::BIGINT AS missing_chunks FROM v_whole_final", uses=("v_whole_final",)
)
def sync_then_pull(spark, d):
    """What a sync stored, rebuilt from the old and the new chunks."""
    _, held, done = _sync(spark, d)
    files = pipelines.pull(done.documents.select("doc_id", "path", "children", "mtime", "size"), held.unionByName(done.chunks), SYNC_RULES)
    return files.select("doc_id", F.sha2("content", 256).alias("hash"), F.col("missing_chunks").cast("long").alias("missing_chunks"))
