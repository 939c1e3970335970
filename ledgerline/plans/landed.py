"""Queries over landed relations: readers' rows, names, decisions, resumes, probes and tallies, each beside its SQL.

Importing this module completes the registry of plans.queries.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import decisions as D
from ..functions import paths as P
from ..operators import outcomes as O
from ..sources import readers as R
from .queries import QUERIES, SQL, query, t

__all__ = ["QUERIES", "SQL"]


def pick(c, *values):
    """values[c % n], as a literal array's element."""
    return F.element_at(F.array(*map(F.lit, values)), (c % len(values) + 1).cast("int"))


# ---- A: readers


@query("""SELECT p_partkey AS id, 'lib/' || p_brand || '/f' || CAST(p_partkey AS VARCHAR) || ['.pdf','.png','.bin'][p_partkey % 3 + 1] AS rel, CAST(CASE WHEN p_partkey % 7 = 0 THEN 0 ELSE p_size END AS BIGINT) AS size,
 CASE WHEN p_partkey % 2 = 0 THEN 'text/plain' ELSE ['application/pdf','image/png','application/octet-stream'][p_partkey % 3 + 1] END AS mime FROM part""")
def manifest_rows(spark, sf_dir):
    """Lines of five columns, or four whose type comes from the name; empty sizes are 0."""
    k = F.col("p_partkey")
    rel = F.concat(F.lit("lib/"), "p_brand", F.lit("/f"), k.cast("string"), pick(k, ".pdf", ".png", ".bin"))
    size = F.when(k % 7 == 0, "").otherwise(F.col("p_size").cast("string"))
    line = F.concat_ws("\t", rel, size, F.lit("drive"), k.cast("string"), F.when(k % 2 == 0, "text/plain"))
    return R.manifest_rows(t(spark, sf_dir, "part").select(line.alias("value"))).select(F.col("item").cast("long").alias("id"), "rel", "size", "mime")


@query("""SELECT 'n' || CAST(s_suppkey AS VARCHAR) || '/a' AS name, CAST(s_suppkey * 10 AS BIGINT) AS clen, 'e' || CAST(s_nationkey AS VARCHAR) AS etag FROM supplier UNION ALL SELECT 'n' || CAST(s_suppkey AS VARCHAR) || '/b', 0, '' FROM supplier""")
def list_page_rows(spark, sf_dir):
    """XML list pages; a missing size is 0, a missing etag empty."""
    k = F.col("s_suppkey").cast("string")
    page = F.concat(F.lit("<EnumerationResults><Blobs><Blob><Name>n"), k, F.lit("/a</Name><Properties><Content-Length>"), k, F.lit("0</Content-Length><Etag>e"), F.col("s_nationkey").cast("string"), F.lit("</Etag></Properties></Blob><Blob><Name>n"), k, F.lit("/b</Name><Properties/></Blob></Blobs><NextMarker/></EnumerationResults>"))
    return R.page_rows(t(spark, sf_dir, "supplier").select(page.alias("page")))


@query("SELECT CAST(event_id AS VARCHAR) AS id, event_type FROM events WHERE event_id % 9 NOT IN (0, 1, 2)")
def tolerant_lines(spark, sf_dir):
    """JSON lines; broken and blank ones and those without an id go, ids are text."""
    e = F.col("event_id")
    good = F.to_json(F.struct(e.alias("id"), "event_type"))
    line = F.when(e % 9 == 0, '{"id": 1, "event').when(e % 9 == 1, "").when(e % 9 == 2, F.to_json(F.struct("event_type"))).otherwise(good)
    return R.rows_of_lines(t(spark, sf_dir, "events").select(line.alias("value")), "id string, event_type string").where("id is not null").select("id", "event_type")


@query("""SELECT c_custkey AS slug, CASE WHEN c_custkey % 3 = 0 THEN 'stalled' ELSE 'pushing' END AS stage, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE CAST(c_custkey * 10 AS BIGINT) END AS declared, c_custkey % 4 <> 0 AS known FROM customer WHERE c_custkey % 10 <> 9""")
def entity_defaults(spark, sf_dir):
    """A1 to A5: entities with manifest and status; absent ones are unknown or pushing, dot folders hidden."""
    c = t(spark, sf_dir, "customer").withColumn("folder", F.concat(F.when(F.col("c_custkey") % 10 == 9, ".archive").otherwise("c"), F.col("c_custkey").cast("string")))
    manifest = c.where("c_custkey % 4 <> 0").select("c_custkey", (F.col("c_custkey") * 10).cast("long").alias("declared"))
    status = c.where("c_custkey % 3 = 0").select("c_custkey", F.lit("stalled").alias("stage"))
    j = c.where("not startswith(folder, '.')").join(manifest, "c_custkey", "left").join(status, "c_custkey", "left")
    return j.select(F.col("c_custkey").alias("slug"), F.coalesce("stage", F.lit("pushing")).alias("stage"), "declared", F.col("declared").isNotNull().alias("known"))


@query("""WITH m AS (SELECT user_id, ts, event_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE event_id * 3 END AS avg FROM events), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM m WHERE avg IS NOT NULL)
 SELECT user_id, CAST(avg AS BIGINT) AS capacity FROM r WHERE rn = 1""")
def latest_capacity(spark, sf_dir):
    """The latest point of a metric that has a value."""
    m = t(spark, sf_dir, "events").select("user_id", F.struct("ts", "event_id").alias("at"), F.when(F.col("event_id") % 4 != 0, F.col("event_id") * 3).alias("avg"))
    return m.where("avg is not null").groupBy("user_id").agg(F.max_by("avg", "at").cast("long").alias("capacity"))


@query("""SELECT name, etag, CASE WHEN seed THEN uncomp * 2 ELSE uncomp END AS uncomp FROM (SELECT 'b' || CAST(doc_id AS VARCHAR) AS name, md5(CAST(doc_id AS VARCHAR)) AS etag, n_chars AS uncomp, doc_id % 5 = 0 AS seed FROM documents)""")
def seeded_cache(spark, sf_dir):
    """A crashed run's rows win over the cache's."""
    d = t(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("b"), F.col("doc_id").cast("string")).alias("name"), F.md5(F.col("doc_id").cast("string").cast("binary")).alias("etag"), F.col("n_chars").alias("uncomp"))
    return R.seeded(d.drop("doc_id"), d.where("doc_id % 5 = 0").drop("doc_id").withColumn("uncomp", F.col("uncomp") * 2))


@query("SELECT l_linestatus AS state, count(*) FILTER (l_returnflag <> 'R') AS versions, count(*) FILTER (l_returnflag = 'R') AS delete_markers, count(*) FILTER (l_returnflag <> 'R' AND l_linenumber = 1) AS latest FROM lineitem GROUP BY 1")
def version_counts(spark, sf_dir):
    """Versions, delete markers apart."""
    gone = F.col("l_returnflag") == "R"
    return t(spark, sf_dir, "lineitem").groupBy(F.col("l_linestatus").alias("state")).agg(F.count_if(~gone).alias("versions"), F.count_if(gone).alias("delete_markers"), F.count_if(~gone & (F.col("l_linenumber") == 1)).alias("latest"))


@query("""WITH g AS (SELECT p_brand || '/' || p_type AS rel, min(p_size) AS lo, max(p_size) AS hi FROM part WHERE p_partkey % 6 <> 0 GROUP BY 1) SELECT rel, CASE WHEN lo = hi THEN CAST(lo AS BIGINT) END AS size, lo <> hi AS collision FROM g""")
def walk_collisions(spark, sf_dir):
    """Paths of a walk; folders and deleted items go, a path with two sizes is nobody's."""
    p = t(spark, sf_dir, "part").select(F.concat_ws("/", "p_brand", "p_type").alias("rel"), F.col("p_size").cast("long").alias("size"), (F.col("p_partkey") % 12 == 0).alias("is_folder"), (F.col("p_partkey") % 12 == 6).alias("deleted"))
    expected, collisions = R.walked(p)
    return expected.withColumn("collision", F.lit(False)).unionByName(collisions.select("rel", F.lit(None).cast("long").alias("size"), F.lit(True).alias("collision")))


@query("""SELECT o_orderkey AS module, CASE WHEN o_orderstatus = 'P' THEN 'deleted' WHEN o_orderkey % 4 = 0 THEN 'api_supported=false' END AS reason FROM orders WHERE o_orderkey % 10 <> 3""")
def catalogue_split(spark, sf_dir):
    """Usable modules and skipped ones with the reason; nameless rows go."""
    o = t(spark, sf_dir, "orders").withColumn("name", F.when(F.col("o_orderkey") % 10 != 3, F.col("o_orderkey")))
    reason = F.when(F.col("o_orderstatus") == "P", "deleted").when(F.col("o_orderkey") % 4 == 0, "api_supported=false")
    return o.where(F.col("name").isNotNull() & D.listed(F.col("o_orderpriority"), [])).select(F.col("name").alias("module"), reason.alias("reason"))


@query("""SELECT c_custkey AS id, c_mktsegment AS body, CAST(1 AS BIGINT) AS page FROM customer WHERE c_custkey % 3 <> 0 UNION ALL SELECT NULL, c_mktsegment, min(CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 2 END) FROM customer WHERE c_custkey % 3 = 0 GROUP BY 2""")
def paged_dedup(spark, sf_dir):
    """Overlapping pages, deduplicated by id or, without one, by the row's canonical JSON; the first page wins."""
    c = t(spark, sf_dir, "customer").select(F.when(F.col("c_custkey") % 3 != 0, F.col("c_custkey")).alias("id"), F.col("c_mktsegment").alias("body"), F.when(F.col("c_custkey") % 2 == 0, 1).otherwise(2).cast("long").alias("page"))
    pages = c.union(c.withColumn("page", F.col("page") + 1)).union(c.where("id is not null").withColumn("page", F.lit(1).cast("long")))
    return R.first_per_row(pages, "id", ["id", "body"], "page")


@query("""SELECT 'teams' AS relation, count(*) AS n, CAST(0 AS BIGINT) AS refused FROM nation UNION ALL SELECT 'channels', count(*), 0 FROM customer UNION ALL SELECT 'channel_members', count(*) FILTER (o_orderstatus <> 'P'), count(*) FILTER (o_orderstatus = 'P') FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment <> 'BUILDING'""")
def meta_relations(spark, sf_dir):
    """Counts of a directory's relations; members only of non-standard channels, refusals counted as rows."""
    none = F.lit(0).cast("long").alias("refused")
    channels = t(spark, sf_dir, "customer")
    members = t(spark, sf_dir, "orders").join(channels.where("c_mktsegment <> 'BUILDING'"), F.col("o_custkey") == F.col("c_custkey"), "left_semi")
    refused = F.col("o_orderstatus") == "P"
    teams = t(spark, sf_dir, "nation").agg(F.lit("teams").alias("relation"), F.count("*").alias("n"), none)
    return teams.union(channels.agg(F.lit("channels"), F.count("*"), none)).union(members.agg(F.lit("channel_members"), F.count_if(~refused), F.count_if(refused)))


@query("SELECT count(*) AS repos, count(*) FILTER (p_partkey % 2 = 0) AS private, count(*) FILTER (p_partkey % 5 = 0) AS archived, CAST(sum(p_size) * 1024 AS BIGINT) AS bytes, count(*) FILTER (contains(p_type, 'BRASS')) AS lfs FROM part")
def repository_probe(spark, sf_dir):
    """A catalogue's counts and size over all rows."""
    k = F.col("p_partkey")
    return t(spark, sf_dir, "part").agg(F.count("*").alias("repos"), F.count_if(k % 2 == 0).alias("private"), F.count_if(k % 5 == 0).alias("archived"), (F.sum("p_size") * 1024).cast("long").alias("bytes"), F.count_if(F.contains("p_type", F.lit("BRASS"))).alias("lfs"))


@query("""WITH m AS (SELECT max(date_trunc('month', o_orderdate)) AS m FROM orders WHERE o_orderstatus = 'F') SELECT CAST(m AS DATE) AS month, o_orderpriority AS kind, count(*) AS n FROM orders, m WHERE date_trunc('month', o_orderdate) = m GROUP BY 1, 2""")
def latest_pullable_month(spark, sf_dir):
    """The latest month that has a pullable file, however long ago, by type."""
    o = t(spark, sf_dir, "orders").select(F.trunc(F.col("o_orderdate"), "MM").alias("month"), F.col("o_orderpriority").alias("kind"), "o_orderstatus")
    last = o.where("o_orderstatus = 'F'").agg(F.max("month").alias("month"))
    return o.join(F.broadcast(last), "month").groupBy("month", "kind").agg(F.count("*").alias("n"))


@query("""SELECT n_nationkey AS page, n_name AS item, CASE WHEN n_nationkey % 2 = 0 THEN 'c' || CAST(n_nationkey AS VARCHAR) END AS cursor FROM nation UNION ALL SELECT n_nationkey, 'second', CASE WHEN n_nationkey % 2 = 0 THEN 'c' || CAST(n_nationkey AS VARCHAR) END FROM nation""")
def envelope_rows(spark, sf_dir):
    """A page's rows from a bare array or any of its envelope keys, and the next cursor."""
    k = F.col("n_nationkey")
    items = F.concat(F.lit('[{"id":"'), "n_name", F.lit('"},{"pageId":"second"}]'))
    cursor = F.when(k % 2 == 0, F.concat(F.lit(',"paging":{"next":"c'), k.cast("string"), F.lit('"}'))).otherwise("")
    body = F.when(k % 4 == 1, items).otherwise(F.concat(F.lit('{"'), pick(k, "data", "x", "pages", "items"), F.lit('":'), items, cursor, F.lit("}")))
    return R.enveloped(t(spark, sf_dir, "nation").select(k.alias("page"), body.alias("body")), "body", ("data", "pages", "items")).select("page", P.first_of(*(F.get_json_object("item", f"$.{c}") for c in ("id", "pageId", "_id"))).alias("item"), "cursor")


@query("""SELECT s_nationkey AS slug, max(s_suppkey) AS folder, n_name AS matched FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey AND n_nationkey % 2 = 0 GROUP BY 1, 3""")
def census_last(spark, sf_dir):
    """The last census row of each key, with its match."""
    last = t(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("slug")).agg(F.max_by("s_suppkey", "s_suppkey").alias("folder"))
    match = t(spark, sf_dir, "nation").where("n_nationkey % 2 = 0").select(F.col("n_nationkey").alias("slug"), F.col("n_name").alias("matched"))
    return last.join(match, "slug", "left")


# ---- A25, C17, D22, H3, H5, K: archives


@query("""SELECT s_suppkey AS id, CASE WHEN s_suppkey % 3 = 0 THEN 'wrap/' ELSE '' END AS root, s_suppkey % 2 = 0 AS is_export, CAST(1 AS BIGINT) AS day_files, CAST(CASE WHEN s_suppkey % 2 = 0 THEN 4 ELSE 3 END AS BIGINT) AS members FROM supplier""")
def export_archives(spark, sf_dir):
    """archives' members, their root, whether they hold an export, and its day files."""
    import io
    import zipfile

    import pandas as pd

    from ..operators import binary

    def make(batches):
        for df in batches:
            rows = []
            for i in df["s_suppkey"]:
                with zipfile.ZipFile(held := io.BytesIO(), "w") as z:
                    for name in ["channels.json", *(["users.json"] if i % 2 == 0 else []), "général/2024-01-01.json", "a/b/c.json"]:
                        z.writestr(("wrap/" if i % 3 == 0 else "") + name, b"[]")
                rows.append((str(i), held.getvalue()))
            yield pd.DataFrame(rows, columns=["path", "content"])

    e = binary.zip_entries(t(spark, sf_dir, "supplier").select("s_suppkey").mapInPandas(make, "path string, content binary"))
    root = e.where(P.leaf(F.col("entry")) == "channels.json").groupBy("path").agg(F.min_by(F.expr("left(entry, length(entry) - 13)"), F.length("entry")).alias("root"))
    inner = e.join(root, "path").withColumn("rel", F.when(F.startswith("entry", F.col("root")), F.expr("substring(entry, length(root) + 1)")))
    return inner.groupBy(F.col("path").cast("long").alias("id"), "root").agg((F.bool_or(F.col("rel") == "channels.json") & F.bool_or(F.col("rel") == "users.json")).alias("is_export"), F.count_if(F.rlike("rel", F.lit(r"^[^/]+/[^/]+\.json$"))).alias("day_files"), F.count("*").alias("members"))


@query("""SELECT CASE WHEN kind = 'tree' THEN 0 ELSE 1 END AS rank, kind, place, size FROM (SELECT 'tree' AS kind, 'n' || CAST(n_nationkey AS VARCHAR) AS place, CAST(0 AS BIGINT) AS size FROM nation WHERE n_nationkey % 3 = 0 UNION ALL SELECT 'zip', 'z' || CAST(p_partkey AS VARCHAR) || '.ZIP', CAST(p_size AS BIGINT) FROM part)""")
def export_candidates(spark, sf_dir):
    """H4: trees that hold both signature files come before archives, those by size."""
    n, k = t(spark, sf_dir, "nation"), F.concat(F.lit("n"), F.col("n_nationkey").cast("string"))
    names = n.select(F.concat(k, F.lit("/channels.json")).alias("name"), F.lit(0).cast("long").alias("size")).union(n.where("n_nationkey % 3 = 0").select(F.concat(k, F.lit("/users.json")), F.lit(0).cast("long")))
    names = names.union(t(spark, sf_dir, "part").select(F.concat(F.lit("z"), F.col("p_partkey").cast("string"), F.lit(".ZIP")), F.col("p_size").cast("long")))
    tree = names.where(P.leaf(F.col("name")).isin("channels.json", "users.json")).groupBy(F.expr("left(name, length(name) - length(substring_index(name, '/', -1)) - 1)").alias("place")).agg(F.count_distinct(P.leaf(F.col("name"))).alias("n")).where("n = 2")
    zips = names.where(P.blob_kind(F.col("name")) == "zip").select(F.lit(1).alias("rank"), F.lit("zip").alias("kind"), F.col("name").alias("place"), "size")
    return tree.select(F.lit(0).alias("rank"), F.lit("tree").alias("kind"), "place", F.lit(0).cast("long").alias("size")).union(zips).orderBy("rank", F.desc("size"), "place")


# ---- B, O: run logs and ledgers


@query("""WITH r AS (SELECT user_id, event_id, epoch(date_trunc('hour', ts))::BIGINT AS s FROM events), k AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY s, event_id) AS k FROM r) SELECT user_id, event_id, k + max(s - k) OVER (PARTITION BY user_id ORDER BY k) AS unique_s FROM k""")
def unique_run_times(spark, sf_dir):
    """Append-only run keys, a second later on collision."""
    e = t(spark, sf_dir, "events").select("user_id", "event_id", F.unix_timestamp(F.date_trunc("hour", F.col("ts").cast("timestamp"))).alias("s"))
    return O.unique_times(e.withColumn("at", F.struct("s", "event_id")), "user_id", "s", "at").select("user_id", "event_id", "unique_s")


@query("SELECT o_orderkey AS blob, CASE WHEN o_orderkey % 5 = 0 THEN 'copied' ELSE o_orderstatus END AS status FROM orders")
def ledger_patch(spark, sf_dir):
    """A ledger's statuses updated where the key is there."""
    o = t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("blob"), F.col("o_orderstatus").alias("status"))
    return R.patched(o, "blob", "status", o.where("blob % 5 = 0").withColumn("status", F.lit("copied")))


@query("""WITH r AS (SELECT CASE WHEN l_orderkey % 10 = 0 THEN '' ELSE CAST(l_orderkey AS VARCHAR) END AS id FROM lineitem) SELECT (SELECT count(*) FROM r WHERE id = '') + (SELECT count(DISTINCT id) FROM r WHERE id <> '') AS kept, (SELECT count(*) FROM r WHERE id <> '') - (SELECT count(DISTINCT id) FROM r WHERE id <> '') AS dropped""")
def ledger_dedup(spark, sf_dir):
    """The first row of each id and all rows without one; what was kept and dropped."""
    rows = t(spark, sf_dir, "lineitem").select(F.when(F.col("l_orderkey") % 10 == 0, "").otherwise(F.col("l_orderkey").cast("string")).alias("id"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"))
    kept = R.first_per_id(rows, "id", "seq").agg(F.count("*").alias("kept"))
    return kept.join(F.broadcast(rows.agg(F.count("*").alias("all")))).select("kept", (F.col("all") - F.col("kept")).alias("dropped"))


@query("""WITH e AS (SELECT l_orderkey AS log, l_linenumber AS line, sum(CAST(l_quantity AS BIGINT)) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS "end" FROM lineitem WHERE l_linenumber > 0) SELECT log, count(*) AS surviving, CAST(max("end") AS BIGINT) AS bytes FROM e WHERE "end" <= 60 GROUP BY 1""")
def resume_offsets(spark, sf_dir):
    """What survives of a ledger up to its committed offset, and counts from it."""
    l = t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("log"), F.col("l_linenumber").alias("line"), F.col("l_quantity").cast("long").alias("size"))
    return O.committed(l, "log", "line", "size", F.lit(60)).groupBy("log").agg(F.count("*").alias("surviving"), F.max("end").alias("bytes"))


@query("SELECT CASE WHEN p_partkey % 4 = 0 THEN 'run-metadata' ELSE 'unit' END AS class, CASE WHEN p_partkey % 4 = 0 THEN 'overwrite' ELSE 'create-only' END AS mode, count(*) AS files FROM part GROUP BY 1, 2")
def publish_modes(spark, sf_dir):
    """How files would be published: units are published create-only, a run's metadata is overwritten."""
    meta = F.startswith("path", F.lit("_meta/"))
    p = t(spark, sf_dir, "part").select(F.concat(F.when(F.col("p_partkey") % 4 == 0, "_meta/").otherwise("files/"), F.col("p_partkey").cast("string")).alias("path"))
    return p.groupBy(F.when(meta, "run-metadata").otherwise("unit").alias("class"), F.when(meta, "overwrite").otherwise("create-only").alias("mode")).agg(F.count("*").alias("files"))


@query("""SELECT c_custkey AS entity, CASE WHEN c_custkey % 7 = 0 THEN 'failed' WHEN n IS NULL THEN 'skipped-unchanged' WHEN open > 0 THEN 'in-flight' ELSE 'sized' END AS outcome FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, count(*) FILTER (o_orderstatus = 'P') AS open FROM orders GROUP BY 1) ON o_custkey = c_custkey""")
def entity_outcomes(spark, sf_dir):
    """Each entity's outcome by itself; one entity's failure touches no other."""
    n = t(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("entity")).agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "P").alias("open"))
    e = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("entity")).join(n, "entity", "left")
    return e.select("entity", D.decide("sized", (F.col("entity") % 7 == 0, "failed"), (F.col("n").isNull(), "skipped-unchanged"), (F.col("open") > 0, "in-flight")).alias("outcome"))


@query("""SELECT c_custkey AS entity, c_custkey % 3 = 0 AND c_custkey % 6 <> 0 AND c_custkey % 5 <> 0 AS archived, c_custkey % 3 = 0 AND c_custkey % 6 <> 0 AND c_custkey % 5 = 0 AS refused, coalesce(n, 0) AS runs FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey""")
def archived_entities(spark, sf_dir):
    """Soft deletes and restores; entities in flight refuse; runs are kept and counted."""
    c = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("entity"), (F.col("c_custkey") % 5 == 0).alias("in_flight"))
    log = c.where("entity % 3 = 0").select("entity", F.lit(1).alias("seq"), F.lit("offboard").alias("action")).union(c.where("entity % 6 = 0").select("entity", F.lit(2), F.lit("restore")))
    runs = t(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("entity")).agg(F.count("*").alias("runs"))
    return O.archived(c, log, "entity").join(runs, "entity", "left").select("entity", "archived", "refused", F.coalesce("runs", F.lit(0)).alias("runs"))


@query("""WITH g AS (SELECT l_suppkey AS module, count(DISTINCT l_partkey) AS kept, CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE count(*) - l_suppkey % 3 END AS want FROM lineitem GROUP BY 1) SELECT module, kept, CASE WHEN want IS NULL THEN 'unknown' WHEN kept >= want THEN 'complete' WHEN module % 2 = 0 THEN 'gap-in-the-middle' ELSE 'partial' END AS state FROM g""")
def walk_completeness(spark, sf_dir):
    """Walks held against the source's count."""
    g = t(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("module")).agg(F.count_distinct("l_partkey").alias("kept"), F.count("*").alias("n"))
    want = F.when(F.col("module") % 5 != 0, F.col("n") - F.col("module") % 3)
    return g.select("module", "kept", O.complete(F.col("kept"), want, F.col("module") % 2 == 0).alias("state"))


# ---- C: names


@query(r"""SELECT page_id, '_noncurrent/' || url || '/v1' AS version_name, 'zip:' || url AS tag, url AS place, lower(coalesce(nullif(regexp_extract(url, '^(https?://[^/]+(/(sites|teams)/[^/]+)?)', 1), ''), url)) AS site, regexp_replace(lower(url), '[^a-z0-9]', '', 'g') AS letters, sha1(page_id || ',' || url) AS digest FROM pages""")
def name_parts(spark, sf_dir):
    """C15, C29, C30, C31, C35, C37."""
    u = F.col("url")
    tag = P.export_tag(F.lit("zip"), u)
    return t(spark, sf_dir, "pages").select("page_id", P.version_name(u, F.lit("v1")).alias("version_name"), tag.alias("tag"), P.export_of_tag(tag)[1].alias("place"), P.site_collection(u).alias("site"), P.letters_only(u).alias("letters"), P.list_digest(F.array(F.col("page_id").cast("string"), u)).alias("digest"))


@query(r"""SELECT p_partkey, 'zoom/meetings/' || 'a_b-' || CAST(p_partkey AS VARCHAR) || '/20240101T0' || CAST(p_partkey % 10 AS VARCHAR) || '0000Z_' || ['MP4','CHAT','FILE','TIMELINE'][p_partkey % 4 + 1] || '_' || substr(CAST(p_partkey AS VARCHAR) || 'abcdefghijklmn', 1, 12) || '.' || ['mp4','txt','bin','json'][p_partkey % 4 + 1] AS recording,
 'files/' || CAST(p_size AS VARCHAR) || '/' || CAST(p_partkey AS VARCHAR) || '__' || regexp_replace(p_name, '[^0-9A-Za-z._-]', '_', 'g') AS unit, ['.png','.pdf',''][p_partkey % 3 + 1] AS ext, CAST(p_partkey AS VARCHAR) AS video, ['FC:x','D0123ABCD','other'][p_partkey % 3 + 1] AS conversation, ['file_conversation','dm','unknown'][p_partkey % 3 + 1] AS kind FROM part""")
def media_names(spark, sf_dir):
    """Names of recordings, units, conversations; extensions by content type; ids of URIs."""
    k = F.col("p_partkey")
    s = k.cast("string")
    recording = P.recording_path("zoom", F.concat(F.lit("a/b+?"), s), F.concat(F.lit("2024-01-01T0"), (k % 10).cast("string"), F.lit(":00:00Z")), pick(k, "mp4", "chat", "", "timeline"), F.lit(""), F.concat(s, F.lit("abcdefghijklmn")))
    conversation = pick(k, "FC:x", "D0123ABCD", "other")
    return t(spark, sf_dir, "part").select("p_partkey", recording.alias("recording"), P.unit_label(F.lit("file"), F.col("p_size").cast("string"), s, F.col("p_name")).alias("unit"), P.extension_of_type(pick(k, "image/png; q=1", "Application/PDF", "x/y")).alias("ext"), P.tail_id(F.concat(F.lit("/videos/"), s, F.lit(":hash"))).alias("video"), conversation.alias("conversation"), P.conversation_kind(conversation).alias("kind"))


@query(r"""SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'tok' || CAST(page_id AS VARCHAR) END AS token, CASE WHEN page_id % 2 = 0 THEN base64(unhex(md5(url))) END AS digest, url || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || 't=xoxe-1' AS put, 'a%2520b' AS twice, ['.7z', NULL, '.zst'][page_id % 3 + 1] AS ext FROM pages""")
def url_values(spark, sf_dir):
    """C5, C21, C42, C49, C50."""
    u, k = F.col("url"), F.col("page_id")
    even = k % 2 == 0
    return t(spark, sf_dir, "pages").select("page_id", P.pdf_token(F.concat(F.lit("https://h/x"), F.when(even, F.concat(F.lit("/pdf/tok"), k.cast("string"))).otherwise("/html"))).alias("token"), P.md5_base64(F.when(even, F.md5(u.cast("binary"))).otherwise("zz")).alias("digest"), P.with_query_value(u, "t", F.lit("xoxe-1")).alias("put"), P.encoded_twice(F.lit("a b")).alias("twice"), P.unmeasurable_ext(pick(k, "a.7z", "a.zip", "a.ZST")).alias("ext"))


@query("""SELECT s_suppkey, CAST(greatest(1, (s_suppkey % 120 + 48) // 49) AS BIGINT) AS chunks, CAST(s_suppkey % 120 + greatest(1, (s_suppkey % 120 + 48) // 49) AS BIGINT) AS fields, format('{:,}', s_suppkey * 1000) || CASE WHEN s_suppkey % 2 = 0 THEN ' rows' ELSE ' records' END AS label FROM supplier""")
def field_chunks(spark, sf_dir):
    """Fields in chunks of at most 50, each led by id; labels of counts."""
    k = F.col("s_suppkey")
    names = F.concat(F.array(F.lit("id"), F.lit("id")), F.transform(F.slice(F.sequence(F.lit(0), F.lit(119)), F.lit(1), (k % 120).cast("int")), lambda i: F.concat(F.lit("f"), i.cast("string"))))
    c = P.chunked(names)
    return t(spark, sf_dir, "supplier").select("s_suppkey", F.size(c).cast("long").alias("chunks"), F.size(F.flatten(c)).cast("long").alias("fields"), P.record_label(k * 1000, F.when(k % 2 == 0, "rows")).alias("label"))


@query("SELECT event_id, event_id % 5 IN (0, 1) AS valid FROM events")
def detail_shapes(spark, sf_dir):
    """C11: which measured details have the right shape, service -> [bytes, files]."""
    det = pick(F.col("event_id"), '{"slack":[10,2]}', "{}", '{"slack":[true,2]}', '{"slack":[1]}', "nope")
    return t(spark, sf_dir, "events").select("event_id", D.detail_valid(det).alias("valid"))


# ---- D: decisions


@query("""SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 OR p_partkey % 4 = 1 THEN 'external' WHEN p_partkey % 4 = 2 OR p_partkey % 3 = 0 THEN 'unavailable' ELSE 'hosted' END AS disposition FROM part""")
def file_dispositions(spark, sf_dir):
    """What can be done with a file object."""
    k = F.col("p_partkey")
    return t(spark, sf_dir, "part").select("p_partkey", D.file_disposition(k % 5 == 0, pick(k, "hosted", "external", "tombstone", ""), F.when(k % 3 != 0, "https://h/f").otherwise("")).alias("disposition"))


@query("""SELECT event_id, ['INVALID_TOKEN','','E1','','TOP'][event_id % 5 + 1] AS code, ['','9001','','failure',''][event_id % 5 + 1] AS failure, FALSE AS capped FROM events""")
def body_codes(spark, sf_dir):
    """Error codes of bodies in several envelopes, failures that a good status hides."""
    body = pick(F.col("event_id"), '{"data":[{"code":"INVALID_TOKEN"}]}', '{"result":"failure","errorCode":"9001"}', '[{"code":"E1"}]', '{"status":"failure","data":[]}', '{"error":"TOP"}')
    return t(spark, sf_dir, "events").select("event_id", D.body_error(body).alias("code"), D.body_failed(body).alias("failure"), D.page_cap(D.body_error(body)).alias("capped"))


@query("""SELECT o_orderkey, o_orderstatus IN ('F','O') AND o_orderkey % 3 <> 0 AS public, o_orderkey % 4 <> 0 AS pullable, o_orderkey % 5 = 0 AS absent, o_orderkey % 200 > 0 AND CAST(o_orderkey % 7 AS DOUBLE) / (o_orderkey % 200) > 0.01 AS breach, o_orderkey % 100 >= 50 AND o_orderkey % 6 < 5 AS suspect, o_orderkey % 2 = 1 AS stale FROM orders""")
def row_predicates(spark, sf_dir):
    """Predicates over catalogue rows, diffs and ledgers."""
    k = F.col("o_orderkey")
    status = F.when(F.col("o_orderstatus") == "F", "Live").when(F.col("o_orderstatus") == "O", "Accepted").otherwise("Draft")
    return t(spark, sf_dir, "orders").select(
        "o_orderkey",
        D.public_page(status, k % 3 == 0).alias("public"),
        D.pullable(F.when(k % 4 != 0, "https://h").otherwise(""), F.lit("MP4")).alias("pullable"),
        D.wiki_absent(pick(k, "Repository not found", "fatal: timeout", "ok", "reset", "busy")).alias("absent"),
        D.gate_breach(k % 7, k % 200).alias("breach"),
        D.mapping_suspect(F.lit(9), k % 100, k % 6).alias("suspect"),
        D.verification_stale(k % 2, F.lit(0)).alias("stale"),
    )


# ---- E, F, G, H, I, J: joins, sums and orders


@query("""SELECT s_nationkey AS collection, count(*) AS sites, min(s_name) AS first_name, max(s_suppkey) AS last_id FROM supplier WHERE s_suppkey % 9 <> 0 GROUP BY 1""")
def site_collections(spark, sf_dir):
    """Sites by collection, personal ones left out; counts and ends instead of unbounded lists."""
    return t(spark, sf_dir, "supplier").where("s_suppkey % 9 <> 0").groupBy(F.col("s_nationkey").alias("collection")).agg(F.count("*").alias("sites"), F.min("s_name").alias("first_name"), F.max("s_suppkey").alias("last_id"))


@query("""WITH e AS (SELECT o_orderkey AS k, o_custkey % 20 AS site FROM orders), l AS (SELECT DISTINCT l_orderkey AS k FROM lineitem), x AS (SELECT e.*, l.k IS NULL AND e.k % 3 = 0 AS quarantined, l.k IS NULL AND e.k % 3 <> 0 AS missing FROM e LEFT JOIN l USING (k))
 SELECT site, count(*) AS expected, count(*) FILTER (missing) AS missing, count(*) FILTER (quarantined) AS quarantined, CASE WHEN count(*) FILTER (missing) = 0 THEN 'ok' WHEN count(*) FILTER (missing) * 100 > count(*) THEN 'breach' ELSE 'incomplete' END AS verdict FROM x GROUP BY 1""")
def site_verdict(spark, sf_dir):
    """Per-site manifests against a fresh listing; quarantined items aren't missing."""
    e = t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), (F.col("o_custkey") % 20).alias("site"))
    l = t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.lit(True).alias("there")).distinct()
    absent = F.col("there").isNull()
    g = e.join(l, "k", "left").groupBy("site").agg(F.count("*").alias("expected"), F.count_if(absent & (F.col("k") % 3 != 0)).alias("missing"), F.count_if(absent & (F.col("k") % 3 == 0)).alias("quarantined"))
    return g.withColumn("verdict", D.decide("incomplete", (F.col("missing") == 0, "ok"), (D.gate_breach(F.col("missing"), F.col("expected")), "breach")))


@query("""SELECT l_orderkey AS id, count(*) FILTER (l_linenumber <> 1) AS media, bool_or(l_linenumber = 1) AS has_metadata FROM lineitem GROUP BY 1""")
def tails_by_id(spark, sf_dir):
    """How many path tails each id has, metadata apart."""
    name = F.concat(F.col("l_orderkey").cast("string"), F.lit("/"), F.when(F.col("l_linenumber") == 1, "metadata.json").otherwise(F.concat(F.col("l_linenumber").cast("string"), F.lit(".mp4"))))
    n = t(spark, sf_dir, "lineitem").select(name.alias("name"))
    meta = P.leaf(F.col("name")) == "metadata.json"
    return n.groupBy(F.substring_index("name", "/", 1).cast("long").alias("id")).agg(F.count_if(~meta).alias("media"), F.bool_or(meta).alias("has_metadata"))


@query("""SELECT o_orderstatus AS status, count(*) AS n, count(*) FILTER (o_orderkey % 3 <> 0) AS public, CAST(coalesce(sum(CAST(floor(o_totalprice) AS BIGINT)), 0) AS BIGINT) AS snapshot FROM orders GROUP BY 1""")
def plan_histogram(spark, sf_dir):
    """what a plan would do, by status."""
    return t(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"), F.count_if(F.col("o_orderkey") % 3 != 0).alias("public"), F.coalesce(F.sum(F.floor("o_totalprice")), F.lit(0)).cast("long").alias("snapshot"))


@query("""WITH e AS (SELECT 'e' || CAST(user_id AS VARCHAR) AS error, max(event_id) AS seq FROM events WHERE event_type = (SELECT min(event_type) FROM events) GROUP BY 1) SELECT error, seq FROM e ORDER BY seq DESC LIMIT 5""")
def recent_errors(spark, sf_dir):
    """The five most recent distinct errors of a log (a top-k report)."""
    e = t(spark, sf_dir, "events")
    kind = e.agg(F.min("event_type").alias("event_type"))
    return e.join(F.broadcast(kind), "event_type").groupBy(F.concat(F.lit("e"), F.col("user_id").cast("string")).alias("error")).agg(F.max("event_id").alias("seq")).orderBy(F.desc("seq")).limit(5)


@query("""WITH s AS (SELECT source, CAST(sum(n_chars) AS BIGINT) AS actual FROM documents GROUP BY 1), m AS (SELECT max(actual) AS hi, min(actual) AS lo FROM s) SELECT source, actual, hi >= 100 * lo AS log_scale FROM s, m""")
def chart_rows(spark, sf_dir):
    """H9: entries by size, and whether the scale must be logarithmic."""
    s = t(spark, sf_dir, "documents").groupBy("source").agg(F.sum("n_chars").alias("actual"))
    m = s.agg(F.max("actual").alias("hi"), F.min("actual").alias("lo"))
    return s.crossJoin(F.broadcast(m)).select("source", "actual", (F.col("hi") >= 100 * F.col("lo")).alias("log_scale")).orderBy(F.desc("actual"), "source")


@query("""WITH l AS (SELECT l_orderkey AS k, max(l_linenumber) AS have FROM lineitem GROUP BY 1), w AS (SELECT o_orderkey AS k, o_orderpriority AS folder, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderkey % 5 END AS size FROM orders)
 SELECT folder, CASE WHEN size IS NULL THEN 'no-file' WHEN have IS NULL THEN 'to-copy' WHEN have < size THEN 'short' ELSE 'skipped-existing' END AS outcome, count(*) AS n, CAST(coalesce(sum(size), 0) AS BIGINT) AS bytes FROM w LEFT JOIN l USING (k) GROUP BY 1, 2""")
def resume_outcomes(spark, sf_dir):
    """I8: work items against the listing: what is copied, skipped, short or has no file."""
    k = F.col("o_orderkey")
    work = t(spark, sf_dir, "orders").select(k.alias("k"), F.col("o_orderpriority").alias("folder"), F.when(k % 13 != 0, k % 5).alias("size"))
    landed = t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("size"))
    return O.tallied(O.resumed(work, landed, "k", "size"), "folder", size="size")


@query("""SELECT n_nationkey AS file, 'p' || CAST(i AS VARCHAR) AS page, CAST(CASE WHEN i < 4 THEN 0 ELSE 1 END AS BIGINT) AS batch FROM nation, (SELECT unnest([1, 3, 4]) AS i)""")
def page_nodes(spark, sf_dir):
    """Ids of a document's pages, in batches."""
    node = "array<struct<id:string,type:string>>"
    body = F.lit('{"children":[{"id":"p1","type":"CANVAS"},{"id":"x2","type":"FRAME"},{"id":"p3","type":"CANVAS"},{"id":"p4","type":"CANVAS"}]}')
    d = t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("file"), F.from_json(body, f"children {node}").alias("doc"))
    pages = d.select("file", F.explode(F.filter("doc.children", lambda c: c["type"] == "CANVAS")).alias("c")).select("file", F.col("c.id").alias("page"))
    return O.batched(pages, "file", "page", 2)


# ---- L: times


@query("""SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso, strftime(ts, '%Y%m%dT%H%M%SZ') AS basic, CASE WHEN event_id % 2 = 0 THEN epoch(date_trunc('second', ts))::BIGINT END AS parsed FROM events""")
def iso_times(spark, sf_dir):
    """L1 to L3: times written in two forms and read strictly."""
    ts = F.col("ts")
    text = F.when(F.col("event_id") % 2 == 0, P.iso(ts)).otherwise(P.iso_basic(ts))
    return t(spark, sf_dir, "events").select("event_id", P.iso(ts).alias("iso"), P.iso_basic(ts).alias("basic"), F.unix_timestamp(P.parse_iso(text)).alias("parsed"))


# ---- S, N8: probes and rollups


@query("""WITH r AS (SELECT l_suppkey AS run, l_orderkey * 10 + l_linenumber AS seq, CASE l_returnflag WHEN 'R' THEN 'failed' WHEN 'A' THEN 'ok' ELSE 'partial' END AS status FROM lineitem), g AS (SELECT run, min(seq) FILTER (status = 'ok') AS good FROM r GROUP BY 1) SELECT run, count(*) FILTER (status = 'failed' AND (good IS NULL OR seq < good)) >= 5 AS broken FROM r JOIN g USING (run) GROUP BY 1""")
def breaker_runs(spark, sf_dir):
    """Runs that failed five times before anything succeeded."""
    status = F.when(F.col("l_returnflag") == "R", "failed").when(F.col("l_returnflag") == "A", "ok").otherwise("partial")
    return O.broken(t(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("run"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"), status.alias("status")), "run", "seq")


@query("""WITH s AS (SELECT o_orderpriority AS prefix, count(*) AS src_n, CAST(sum(o_orderkey % 9) AS BIGINT) AS src_bytes FROM orders GROUP BY 1), d AS (SELECT o_orderpriority AS prefix, count(*) AS dst_n, CAST(sum(o_orderkey % 9) AS BIGINT) AS dst_bytes FROM orders WHERE o_orderpriority <> '1-URGENT' AND NOT (o_orderpriority = '5-LOW' AND o_orderkey % 2 = 0) GROUP BY 1)
 SELECT prefix, src_n, src_bytes, dst_n, dst_bytes, CASE WHEN src_n IS NULL OR dst_n IS NULL THEN 'LIST-ERROR' WHEN src_n = dst_n AND src_bytes = dst_bytes THEN 'ok' ELSE 'MISMATCH' END AS status FROM s LEFT JOIN d USING (prefix)""")
def job_rollup(spark, sf_dir):
    """Each job's count and bytes at both ends."""
    o = t(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("prefix"), (F.col("o_orderkey") % 9).alias("size"), "o_orderkey")
    d = o.where("prefix <> '1-URGENT' and not (prefix = '5-LOW' and o_orderkey % 2 = 0)")
    return O.rolled_up(o.select("prefix").distinct(), o, d, "prefix")


@query("""WITH e AS (SELECT o_orderkey AS k, o_orderpriority AS lib FROM orders), l AS (SELECT * FROM e WHERE k IN (SELECT l_orderkey FROM lineitem)), m AS (SELECT * FROM e WHERE k NOT IN (SELECT l_orderkey FROM lineitem) ORDER BY k LIMIT 20), h AS (SELECT lib, count(*) AS n FROM l GROUP BY 1) SELECT lib, k, CAST(least(coalesce(n, 0), 2) AS BIGINT) AS neighbours FROM m LEFT JOIN h USING (lib)""")
def missing_samples(spark, sf_dir):
    """The first missing items with how many neighbours their library has (a report)."""
    e = t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderpriority").alias("lib"))
    l = e.join(t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k")).distinct(), "k", "left_semi")
    return O.gate_samples(e, l, "lib", "k")


@query("""WITH s AS (SELECT event_id, [200, 402, 403, 404][event_id % 4 + 1] AS status FROM events) SELECT CASE status WHEN 200 THEN 'open' WHEN 402 THEN 'metered-model-required' WHEN 403 THEN 'protected-api-approval-missing' ELSE 'unexpected' END AS gate, count(*) AS n FROM s GROUP BY 1""")
def endpoint_gates(spark, sf_dir):
    """How probed endpoints stand."""
    return t(spark, sf_dir, "events").groupBy(D.gate(pick(F.col("event_id"), 200, 402, 403, 404)).alias("gate")).agg(F.count("*").alias("n"))


@query("""SELECT CASE WHEN l_linestatus = 'O' THEN 'STANDARD' ELSE 'GLACIER' END AS tier, count(*) AS n, count(*) FILTER (l_linestatus <> 'O') AS cold FROM lineitem GROUP BY 1""")
def storage_tiers(spark, sf_dir):
    """Objects by storage class, cold ones counted over all rows."""
    cold = F.col("l_linestatus") != "O"
    return t(spark, sf_dir, "lineitem").groupBy(F.when(cold, "GLACIER").otherwise("STANDARD").alias("tier")).agg(F.count("*").alias("n"), F.count_if(cold).alias("cold"))


@query("""SELECT c_custkey AS course, coalesce(n, 0) AS lessons, CASE WHEN n IS NULL THEN 'skipped' ELSE 'ok' END AS status FROM customer LEFT JOIN (SELECT o_custkey, count(*) FILTER (o_orderkey % 4 <> 0) AS n FROM orders GROUP BY 1 HAVING count(*) FILTER (o_orderkey % 4 <> 0) > 0) ON o_custkey = c_custkey""")
def course_lessons(spark, sf_dir):
    """Courses with the lessons that have a URL; a unit without any is one skipped row."""
    lessons = t(spark, sf_dir, "orders").withColumn("url", F.when(F.col("o_orderkey") % 4 != 0, "u")).where("url is not null").groupBy(F.col("o_custkey").alias("course")).agg(F.count("*").alias("n"))
    return t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("course")).join(lessons, "course", "left").select("course", F.coalesce("n", F.lit(0)).alias("lessons"), F.when(F.col("n").isNull(), "skipped").otherwise("ok").alias("status"))


@query("SELECT c_nationkey AS slug, max(c_name) AS latest FROM customer GROUP BY 1")
def latest_report(spark, sf_dir):
    """The latest report by name."""
    return t(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("slug")).agg(F.max("c_name").alias("latest"))
