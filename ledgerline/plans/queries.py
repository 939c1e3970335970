"""Registered queries over the driver's tables, each beside the SQL that gives the same rows.

Tables stand in for the engine's entities: documents are blobs (source the top
prefix, n_chars the size, md5 of the text the etag), orders are units or runs,
lineitem their parts, events a log, pages a listing of URLs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import decisions as D
from ..functions import paths as P
from ..functions import services as S
from ..operators import catalogue, diff, planning, reconcile, sizing, timeseries

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as a listing: source/lang/doc<id>.<ext>, sizes and methods by id."""
    ext = F.element_at(F.array(*map(F.lit, ("zip", "gz", "parquet", "txt", "7z", "xz"))), (F.col("doc_id") % 6 + 1).cast("int"))
    name = F.concat("source", F.lit("/"), "lang", F.lit("/doc"), (F.col("doc_id") % 60).cast("string"), F.lit("."), ext)
    method = F.element_at(F.array(*map(F.lit, ("zip-exact", "gz-trailer", "parquet", "stored", "stored", "xz-exact"))), (F.col("doc_id") % 6 + 1).cast("int"))
    size = F.col("n_chars") - F.col("n_chars") % 1000
    return t(spark, sf_dir, "documents").select("doc_id", name.alias("name"), size.alias("clen"), (size * 3).alias("uncomp"), method.alias("method"))


_BLOBS = """b AS (SELECT doc_id, source || '/' || lang || '/doc' || CAST(doc_id % 60 AS VARCHAR) || '.' || ['zip','gz','parquet','txt','7z','xz'][doc_id % 6 + 1] AS name,
 n_chars - n_chars % 1000 AS clen, (n_chars - n_chars % 1000) * 3 AS uncomp, ['zip-exact','gz-trailer','parquet','stored','stored','xz-exact'][doc_id % 6 + 1] AS method, source, lang FROM documents)"""


# ---- A, B, F: listings and their sums


@query("SELECT source, count(*) AS blobs, CAST(sum(n_chars) AS BIGINT) AS bytes, CAST(sum(n_chars) AS DOUBLE) * 100 / (SELECT sum(n_chars) FROM documents) AS share FROM documents GROUP BY source")
def source_inventory(spark, sf_dir):
    """files, bytes and share of each source."""
    by = t(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("blobs"), F.sum("n_chars").alias("bytes"))
    total = by.agg(F.sum("bytes").alias("total"))
    return by.crossJoin(F.broadcast(total)).select("source", "blobs", "bytes", (F.col("bytes").cast("double") * 100 / F.col("total")).alias("share"))


@query(f"""WITH {_BLOBS}, r AS (SELECT source, source || '/' || lang AS l2, CASE WHEN name LIKE '%.zip' THEN 'zip' WHEN name LIKE '%.gz' THEN 'gz' WHEN name LIKE '%.xz' THEN 'xz' WHEN name LIKE '%.parquet' THEN 'parquet' ELSE 'stored' END AS kind,
 CASE WHEN name LIKE '%.7z' THEN 'unmeasurable' WHEN name LIKE '%.gz' OR name LIKE '%.parquet' THEN 'trusted' ELSE 'measured' END AS coverage, clen, uncomp FROM b),
 u AS (SELECT 'source' AS "grouping", source AS key, clen, uncomp FROM r UNION ALL SELECT 'l2', l2, clen, uncomp FROM r UNION ALL SELECT 'kind', kind, clen, uncomp FROM r UNION ALL SELECT 'coverage', coverage, clen, uncomp FROM r UNION ALL SELECT 'total', '', clen, uncomp FROM r)
 SELECT "grouping", key, count(*) AS blobs, CAST(sum(clen) AS BIGINT) AS comp, CAST(sum(uncomp) AS BIGINT) AS unc, count(*) FILTER (uncomp = 0) AS zero FROM u GROUP BY 1, 2""")
def multi_inventory(spark, sf_dir):
    """All groupings of a listing in one pass."""
    return sizing.inventory(blobs(spark, sf_dir))


@query(f"""WITH {_BLOBS}, g AS (SELECT source || '/' || lang AS l2, CAST(sum(uncomp) AS BIGINT) AS unc FROM b GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY unc DESC, l2) AS rn FROM g)
 SELECT CASE WHEN rn <= 40 THEN l2 ELSE '(other)' END AS l2, CAST(sum(unc) AS BIGINT) AS unc FROM r GROUP BY 1""")
def l2_rollup_capped(spark, sf_dir):
    """the 40 largest second-level groups and the rest."""
    groups = blobs(spark, sf_dir).groupBy(P.second_level(F.col("name")).alias("l2")).agg(F.sum("uncomp").alias("unc"))
    return sizing.capped(groups, "l2", "unc", 40)


@query(r"""SELECT page_id, url, regexp_replace(lower(url), '[^a-z0-9]', '', 'g') AS norm, list_last(string_split(url, '/')) AS leaf, CASE WHEN contains(url, '/') THEN string_split(url, '/')[1] ELSE '(root)' END AS top FROM pages""")
def norm_leaf_projection(spark, sf_dir):
    """C1, C2, C3, C8."""
    u = F.col("url")
    return t(spark, sf_dir, "pages").select("page_id", "url", P.norm(u).alias("norm"), P.leaf(u).alias("leaf"), P.top(u).alias("top"))


_PATHS = "SELECT doc_id, ['export/Slack/day.zip','backup/takeout/Mail/x.mbox','Google Drive/a/b/c.txt','crm data/hubspot-2024/contacts.csv','misc/other/file.bin','a/b/c/d/notion.zip','Takeout/Drive/y.zip','JIRA'][doc_id % 8 + 1] AS path FROM documents"


@query(f"SELECT doc_id, path, [ 'slack', 'gmail', 'gdrive', 'hubspot', NULL, 'notion', 'gdrive', 'jira' ][doc_id % 8 + 1] AS service FROM ({_PATHS})")
def path_service_match(spark, sf_dir):
    """The service of a path, deepest first."""
    names = ("export/Slack/day.zip", "backup/takeout/Mail/x.mbox", "Google Drive/a/b/c.txt", "crm data/hubspot-2024/contacts.csv", "misc/other/file.bin", "a/b/c/d/notion.zip", "Takeout/Drive/y.zip", "JIRA")
    path = F.element_at(F.array(*map(F.lit, names)), (F.col("doc_id") % 8 + 1).cast("int"))
    return t(spark, sf_dir, "documents").select("doc_id", path.alias("path")).withColumn("service", S.of_path(F.col("path"), S.matcher()))


@query("SELECT CASE doc_id % 8 WHEN 0 THEN 'slack' WHEN 1 THEN 'gmail' WHEN 2 THEN 'gdrive' WHEN 3 THEN 'hubspot' WHEN 5 THEN 'notion' WHEN 6 THEN 'gdrive' ELSE 'jira' END AS service, CAST(sum(n_chars) AS BIGINT) AS bytes, count(*) AS blobs FROM documents WHERE doc_id % 8 <> 4 GROUP BY 1")
def detected_services(spark, sf_dir):
    """R2: bytes credited to detected services."""
    names = ("export/Slack/day.zip", "backup/takeout/Mail/x.mbox", "Google Drive/a/b/c.txt", "crm data/hubspot-2024/contacts.csv", "misc/other/file.bin", "a/b/c/d/notion.zip", "Takeout/Drive/y.zip", "JIRA")
    path = F.element_at(F.array(*map(F.lit, names)), (F.col("doc_id") % 8 + 1).cast("int"))
    rows = t(spark, sf_dir, "documents").select(S.of_path(path, S.matcher()).alias("service"), F.col("n_chars").alias("uncomp"), F.lit(None).cast("map<string,bigint>").alias("entries"))
    return sizing.detected(rows)


@query("SELECT page_id, CASE WHEN regexp_extract(url, '[?&]ref=([^&#]*)', 1) = '' THEN NULL ELSE regexp_extract(url, '[?&]ref=([^&#]*)', 1) END AS ref, regexp_replace(regexp_replace(regexp_replace(url, '([?&])ref=[^&#]*(&?)', '\\1', 'g'), '\\?&', '?', 'g'), '[?&](#|$)', '\\1', 'g') AS stripped FROM pages".replace("\\\\", "\\"))
def url_token_strip(spark, sf_dir):
    """A query's value, and the URL without it."""
    u = F.col("url")
    return t(spark, sf_dir, "pages").select("page_id", P.query_value(u, "ref").alias("ref"), P.without_query_value(u, "ref").alias("stripped"))


@query("SELECT page_id, lower(regexp_extract(url, '^https?://([^/?#:]+)', 1)) AS host, regexp_matches(lower(regexp_extract(url, '^https?://([^/?#:]+)', 1)), '(^|\\.)example\\.(com|org)$') AS allowed FROM pages".replace("\\\\", "\\"))
def host_allowlist(spark, sf_dir):
    """C22, C34."""
    u = F.col("url")
    return t(spark, sf_dir, "pages").select("page_id", F.lower(F.try_parse_url(u, F.lit("HOST"))).alias("host"), P.host_allowed(u, ["example.com", "example.org"]).alias("allowed"))


@query(r"""SELECT p_partkey, coalesce(nullif(regexp_replace(regexp_replace(p_name, '[^0-9A-Za-z._-]', '_', 'g'), '^[._-]+|[._-]+$', '', 'g'), ''), 'unnamed') AS safe, 'files/' || substr(CAST(p_partkey + 100000 AS VARCHAR), 1, 4) || '/' || CAST(p_partkey + 100000 AS VARCHAR) || '/' || coalesce(nullif(regexp_replace(regexp_replace(p_name, '[^0-9A-Za-z._-]', '_', 'g'), '^[._-]+|[._-]+$', '', 'g'), ''), 'unnamed') AS path FROM part""")
def safe_component_paths(spark, sf_dir):
    """C23, C24, C25, C36."""
    fid = (F.col("p_partkey") + 100000).cast("string")
    return t(spark, sf_dir, "part").select("p_partkey", P.safe_component(F.col("p_name")).alias("safe"), P.file_path(fid, F.col("p_name")).alias("path"))


@query("SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DOUBLE) / 1e9 AS gb, CAST(length(md5(CAST(l_orderkey AS VARCHAR))) AS BIGINT) AS digest_length, base64(CAST(lpad(CAST(l_linenumber AS VARCHAR), 8, '0') AS BLOB)) AS block_id FROM lineitem")
def humanize(spark, sf_dir):
    """C13, C53 (C12 has a pytest, for its rounding differs between engines)."""
    return t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", P.gigabytes(F.col("l_extendedprice")).alias("gb"), F.length(F.md5(F.col("l_orderkey").cast("string").cast("binary"))).cast("long").alias("digest_length"), P.block_id(F.col("l_linenumber")).alias("block_id"))


# ---- D: decision tables


@query("""WITH s AS (SELECT event_id, [200,204,401,402,403,404,408,429,500,400][event_id % 10 + 1] AS status, ['messages','file','nodes'][event_id % 3 + 1] AS family, event_id % 2 = 0 AS required FROM events)
 SELECT event_id, CASE WHEN status IN (200,204) THEN 'ok' WHEN status = 429 THEN 'sleep' WHEN status = 401 THEN 'remint' WHEN status >= 500 OR status = 408 THEN 'retry' ELSE 'skip' END AS site,
 CASE WHEN status IN (200,204) THEN 'ok' WHEN status = 429 THEN 'sleep' WHEN status = 401 THEN 'remint' WHEN status >= 500 OR status = 408 THEN 'retry' WHEN required OR (family = 'messages' AND status IN (402,403)) THEN 'fatal' WHEN status IN (403,404) THEN 'skip' ELSE 'retry' END AS directory,
 CASE WHEN status = 429 THEN 'sleep' WHEN (status = 400 AND family IN ('file','nodes')) OR (status >= 500 AND family = 'file') THEN 'decompose' WHEN status >= 500 THEN 'retry' WHEN required THEN 'fatal' ELSE 'skip' END AS design,
 CASE WHEN status = 401 THEN 'remint-once-then-fatal' WHEN status = 403 THEN 'skip' WHEN status = 429 THEN 'sleep' WHEN status >= 500 THEN 'retry' WHEN required THEN 'fatal' ELSE 'skip' END AS crm,
 CASE WHEN status = 200 THEN 'ok' WHEN status = 429 THEN 'sleep' WHEN status IN (403,408) OR status >= 500 THEN 'retry' ELSE 'fallback' END AS copied FROM s""")
def outcome_tables(spark, sf_dir):
    """What a response status leads to."""
    e = t(spark, sf_dir, "events")
    pick = lambda xs: F.element_at(F.array(*map(F.lit, xs)), (F.col("event_id") % len(xs) + 1).cast("int"))
    s = e.select("event_id", pick((200, 204, 401, 402, 403, 404, 408, 429, 500, 400)).alias("status"), pick(("messages", "file", "nodes")).alias("family"), (F.col("event_id") % 2 == 0).alias("required"))
    st, fa, rq = F.col("status"), F.col("family"), F.col("required")
    return s.select("event_id", D.site_outcome(st).alias("site"), D.directory_outcome(st, fa, rq).alias("directory"), D.design_outcome(st, fa, rq).alias("design"), D.crm_outcome(st, F.lit(""), rq).alias("crm"), D.copy_outcome(st, F.lit(""), F.lit("")).alias("copied"))


@query(f"""WITH {_BLOBS} SELECT doc_id, method IN ('zip-exact','xz-exact') OR starts_with(method, 'parquet') AS terminal, method IN ('zip-exact','xz-exact') AS streamed, clen >= 4 AND method = 'gz-trailer' AND clen >= 2000 AS candidate, name LIKE '%.gz' AND clen >= 4 AND method <> 'gz-exact' AND clen >= 2000 AS stale FROM b""")
def method_predicates(spark, sf_dir):
    """D2 to D5, with a small threshold for large blobs."""
    b, m, n = blobs(spark, sf_dir), F.col("method"), F.col("clen")
    return b.select("doc_id", D.method_terminal(m).alias("terminal"), D.method_streamed(m).alias("streamed"), (D.gz_stream_candidate(m, n, large=2000, small=10) & (m == "gz-trailer")).alias("candidate"), ((P.blob_kind(F.col("name")) == "gz") & D.gz_row_stale(m, n, F.col("uncomp"), large=2000, small=10)).alias("stale"))


# ---- E, I: matching, reconciliation, deductions

_DECLARED = "d AS (SELECT n_name AS service, CAST(n_nationkey * 1000000 AS BIGINT) AS declared FROM nation)"


def _received(spark, sf_dir):
    s, l = t(spark, sf_dir, "supplier"), t(spark, sf_dir, "lineitem")
    n = t(spark, sf_dir, "nation").where("n_nationkey % 7 <> 3")
    per = l.groupBy("l_suppkey").agg(F.count("*").alias("blobs"), F.sum(F.col("l_quantity").cast("long")).alias("unc"))
    return per.join(s, F.col("l_suppkey") == F.col("s_suppkey")).join(F.broadcast(n), F.col("s_nationkey") == F.col("n_nationkey")).groupBy(F.concat(F.lit("export/"), F.lower("n_name")).alias("source")).agg(F.sum("blobs").alias("blobs"), F.sum("unc").alias("unc")).withColumn("comp", F.col("unc")).withColumn("deduplicated", F.lit(0).cast("long"))


@query(f"""WITH {_DECLARED}, a AS (SELECT n_name AS service, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS actual, count(*) AS blobs FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey WHERE n_nationkey % 7 <> 3 GROUP BY 1)
 SELECT service, declared, coalesce(actual, 0) AS actual, coalesce(blobs, 0) AS blobs, CASE WHEN declared > 0 THEN coalesce(actual, 0) * 100.0 / declared END AS pct,
 CASE WHEN declared = 0 AND coalesce(actual, 0) > 0 THEN 'zero-declared-has-data' WHEN declared > 0 AND coalesce(actual, 0) = 0 THEN 'declared-empty' WHEN declared > 0 AND actual > declared THEN 'overshoot' ELSE '' END AS flags FROM d LEFT JOIN a USING (service)""")
def service_reconcile(spark, sf_dir):
    """Declared services against received sources."""
    services = t(spark, sf_dir, "nation").select(F.col("n_name").alias("service"), (F.col("n_nationkey") * 1000000).cast("long").alias("declared"), F.lit(None).cast("long").alias("records"), F.lit(None).cast("array<string>").alias("prefix"), F.lit(None).cast("long").alias("equivalent"))
    found = services.where("false").select("service", F.col("declared").alias("bytes"))
    rows = reconcile.service_rows(services, _received(spark, sf_dir), found)
    return rows.select("service", "declared", "actual", "blobs", "pct", F.array_join("flags", ",").alias("flags"))


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def unexpected_sources_anti(spark, sf_dir):
    """What nobody declared."""
    return t(spark, sf_dir, "customer").join(t(spark, sf_dir, "orders").where("o_orderstatus = 'P'"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("""WITH s AS (SELECT l_returnflag AS source, count(*) AS blobs, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS unc FROM lineitem GROUP BY 1), c AS (SELECT l_returnflag AS parent, l_returnflag || '/' || l_linestatus AS source, count(*) AS blobs, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS unc FROM lineitem WHERE l_linenumber <= 5 AND l_returnflag <> 'N' GROUP BY 1, 2),
 z AS (SELECT parent, sum(blobs) AS blobs, sum(unc) AS unc FROM c GROUP BY 1)
 SELECT source, blobs, unc FROM s WHERE source NOT IN (SELECT parent FROM z) UNION ALL SELECT source, blobs, unc FROM c UNION ALL SELECT source || '/(unaccounted)', CAST(greatest(s.blobs - z.blobs, 0) AS BIGINT), CAST(greatest(s.unc - z.unc, 0) AS BIGINT) FROM s JOIN z ON s.source = z.parent WHERE s.blobs > z.blobs OR s.unc > z.unc""")
def effective_sources_split(spark, sf_dir):
    """Split parents, their children and the remainder."""
    l = t(spark, sf_dir, "lineitem").withColumn("q", F.col("l_quantity").cast("long"))
    agg = (F.count("*").alias("blobs"), F.sum("q").alias("comp"), F.sum("q").alias("unc"))
    sources = l.groupBy(F.col("l_returnflag").alias("source")).agg(*agg)
    children = l.where("l_linenumber <= 5 and l_returnflag <> 'N'").groupBy(F.col("l_returnflag").alias("parent"), F.concat_ws("/", "l_returnflag", "l_linestatus").alias("source")).agg(*agg)
    return reconcile.split_sources(sources, children, sources.select("source")).select("source", "blobs", "unc")


@query("""WITH s AS (SELECT source, count(*) AS blobs, CAST(sum(n_chars) AS BIGINT) AS unc FROM documents GROUP BY 1) SELECT source, blobs, CASE WHEN source IN ('src3','src4') THEN unc - 5000 ELSE unc END AS unc, CAST(CASE WHEN source IN ('src3','src4') THEN 5000 ELSE 0 END AS BIGINT) AS deduplicated FROM s WHERE source NOT IN ('src1','src2')""")
def apply_duplicates(spark, sf_dir):
    """Declared redundant prefixes, whole or in part."""
    s = t(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("blobs"), F.sum("n_chars").alias("comp"), F.sum("n_chars").alias("unc"))
    dup = spark.createDataFrame([("src1", None, True), ("src2", None, True), ("src3", 5000, True), ("src4", 5000, True)], "source string, redundant long, listed boolean")
    return reconcile.deducted(s, F.broadcast(dup)).select("source", "blobs", "unc", "deduplicated")


@query(f"""WITH {_BLOBS}, g AS (SELECT source, list_last(string_split(name, '/')) AS base, clen, uncomp, count(*) AS n FROM b GROUP BY 1, 2, 3, 4 HAVING count(*) > 1) SELECT source, CAST(sum(n - 1) AS BIGINT) AS files, CAST(sum((n - 1) * uncomp) AS BIGINT) AS bytes FROM g GROUP BY 1""")
def duplicate_rollup(spark, sf_dir):
    """F5, F6, R7."""
    return reconcile.duplicate_rollup(blobs(spark, sf_dir))


@query("""SELECT CASE WHEN source IN ('src5','src6') THEN 'excluded' ELSE 'corpus' END AS part, count(*) AS blobs, CAST(sum(n_chars) AS BIGINT) AS bytes FROM documents GROUP BY 1""")
def excluded_prefix_totals(spark, sf_dir):
    """F8, N4."""
    d = t(spark, sf_dir, "documents")
    return d.groupBy(F.when(F.col("source").isin("src5", "src6"), "excluded").otherwise("corpus").alias("part")).agg(F.count("*").alias("blobs"), F.sum("n_chars").alias("bytes"))


@query("""WITH m AS (SELECT o_custkey, CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS raw, CAST(sum(CASE WHEN o_orderstatus = 'P' THEN CAST(floor(o_totalprice) AS BIGINT) ELSE 0 END) AS BIGINT) AS dup FROM orders GROUP BY 1), h AS (SELECT o_custkey, raw - dup AS unc, CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE CAST(2000000 AS BIGINT) END AS manifest FROM m)
 SELECT o_custkey, unc, unc * 100.0 / manifest AS pct, greatest(manifest - unc, 0) + 0 * manifest AS remaining FROM h""")
def headline_and_adjusted(spark, sf_dir):
    """Received, percentage and remainder by entity."""
    o = t(spark, sf_dir, "orders")
    m = o.groupBy("o_custkey").agg(F.sum(F.floor("o_totalprice")).alias("raw"), F.sum(F.when(F.col("o_orderstatus") == "P", F.floor("o_totalprice")).otherwise(0)).alias("dup"))
    h = reconcile.headline(F.col("raw"), F.col("dup"), F.lit(0), F.when(F.col("o_custkey") % 5 != 0, F.lit(2000000).cast("long")))
    manifest = F.when(F.col("o_custkey") % 5 != 0, F.lit(2000000).cast("long"))
    return m.select("o_custkey", h["unc"].alias("unc"), h["pct"].alias("pct"), F.when(manifest.isNotNull(), h["remaining"]).alias("remaining"))


@query("""WITH m AS (SELECT o_orderkey AS key, o_orderkey % 7 + 1 AS size FROM orders), d AS (SELECT l_orderkey AS key, count(*) AS size FROM lineitem WHERE l_orderkey % 11 <> 0 GROUP BY 1) SELECT CASE WHEN d.key IS NULL THEN 'MISSING-DEST' WHEN m.key IS NULL THEN 'EXTRA-DEST' WHEN m.size <> d.size THEN 'SIZE-DIFF' ELSE 'ok' END AS status, count(*) AS n, CAST(sum(coalesce(m.size, 0)) AS BIGINT) AS src_bytes, CAST(sum(coalesce(d.size, 0)) AS BIGINT) AS dst_bytes FROM m FULL JOIN d ON m.key = d.key GROUP BY 1""")
def manifest_diff_full_outer(spark, sf_dir):
    """Totals of a full-outer comparison."""
    return diff.diff_totals(_orders_diff(spark, sf_dir))


def _orders_diff(spark, sf_dir):
    m = t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), (F.col("o_orderkey") % 7 + 1).alias("size"))
    d = t(spark, sf_dir, "lineitem").where("l_orderkey % 11 <> 0").groupBy(F.col("l_orderkey").alias("key")).agg(F.count("*").alias("size"))
    return diff.manifest_diff(m, d)


@query("""WITH m AS (SELECT o_orderkey AS key, o_orderkey % 7 + 1 AS size FROM orders), d AS (SELECT l_orderkey AS key, count(*) AS size FROM lineitem WHERE l_orderkey % 11 <> 0 GROUP BY 1) SELECT coalesce(m.key, d.key) AS key, m.size AS src_bytes, d.size AS dst_bytes, CASE WHEN d.key IS NULL THEN 'MISSING-DEST' WHEN m.key IS NULL THEN 'EXTRA-DEST' ELSE 'SIZE-DIFF' END AS status FROM m FULL JOIN d ON m.key = d.key WHERE m.key IS NULL OR d.key IS NULL OR m.size <> d.size ORDER BY 1 LIMIT 1000""")
def manifest_diff_sample_cap(spark, sf_dir):
    """The report's sample of mismatches (a limit is the feature)."""
    return diff.mismatch_sample(_orders_diff(spark, sf_dir))


@query(r"""WITH e AS (SELECT p_brand AS folder, regexp_replace('f' || CAST(p_partkey AS VARCHAR) || '../x', '\.+(/|$)', '\1', 'g') AS rel, p_size AS want FROM part WHERE p_partkey % 5 <> 0), d AS (SELECT p_brand AS folder, 'f' || CAST(p_partkey AS VARCHAR) || '/x' AS rel, CASE WHEN p_partkey % 9 = 0 THEN p_size + 1 ELSE p_size END AS have FROM part WHERE p_partkey % 4 <> 0 UNION ALL SELECT p_brand, 'f' || CAST(p_partkey AS VARCHAR) || '/x.meta.json', 1 FROM part WHERE p_partkey % 3 = 0)
 SELECT coalesce(e.folder, d.folder) AS folder, count(*) FILTER (have IS NULL) AS missing, count(*) FILTER (want <> have) AS mismatched, count(*) FILTER (want = have) AS matched, CAST(coalesce(sum(want) FILTER (want = have), 0) AS BIGINT) AS matched_bytes, count(*) FILTER (want IS NULL AND NOT ends_with(d.rel, '.meta.json')) AS dest_only, count(*) FILTER (want IS NULL AND ends_with(d.rel, '.meta.json')) AS sidecars FROM e FULL JOIN d ON e.folder = d.folder AND e.rel = d.rel GROUP BY 1""")
def folder_diff_normalised(spark, sf_dir):
    """E10, C33, R10, F9."""
    p = t(spark, sf_dir, "part")
    key = F.concat(F.lit("f"), F.col("p_partkey").cast("string"))
    e = p.where("p_partkey % 5 <> 0").select(F.col("p_brand").alias("folder"), F.concat(key, F.lit("../x")).alias("rel"), F.col("p_size").alias("size"))
    d = p.where("p_partkey % 4 <> 0").select(F.col("p_brand").alias("folder"), F.concat(key, F.lit("/x")).alias("rel"), F.when(F.col("p_partkey") % 9 == 0, F.col("p_size") + 1).otherwise(F.col("p_size")).alias("size"))
    side = p.where("p_partkey % 3 = 0").select(F.col("p_brand").alias("folder"), F.concat(key, F.lit("/x.meta.json")).alias("rel"), F.lit(1).alias("size"))
    return diff.folder_diff(e, d.union(side))


@query("""WITH c AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN 'supplier#' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') WHEN c_custkey % 3 = 1 THEN CAST(c_nationkey AS VARCHAR) ELSE 'none' END AS folder, c_nationkey FROM customer),
 s AS (SELECT s_suppkey, lower(s_name) AS slug FROM supplier)
 SELECT c.id, s.s_suppkey, n.n_name, CASE WHEN s.s_suppkey IS NOT NULL THEN 'slug' WHEN n.n_name IS NOT NULL THEN 'guid' ELSE 'ambiguous' END AS confidence FROM c LEFT JOIN s ON c.folder = s.slug LEFT JOIN nation n ON s.s_suppkey IS NULL AND c.folder = CAST(n.n_nationkey AS VARCHAR)""")
def cascading_match(spark, sf_dir):
    """Match by one key, else by the next."""
    c = t(spark, sf_dir, "customer")
    folder = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("supplier#"), F.lpad(F.col("c_custkey").cast("string"), 9, "0"))).when(F.col("c_custkey") % 3 == 1, F.col("c_nationkey").cast("string")).otherwise("none")
    c = c.select(F.col("c_custkey").alias("id"), folder.alias("folder"))
    slug = t(spark, sf_dir, "supplier").select(F.lower("s_name").alias("folder"), "s_suppkey")
    guid = t(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("folder"), "n_name")
    return catalogue.matched(c, "folder", {"slug": slug, "guid": guid}).select("id", "s_suppkey", "n_name", "confidence")


@query("""WITH g AS (SELECT o_custkey, CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS census FROM orders GROUP BY 1) SELECT c_custkey, census, greatest(census, CAST(c_custkey * 1000 AS BIGINT)) AS order_bytes FROM customer JOIN g ON o_custkey = c_custkey WHERE census >= 1000000 ORDER BY census DESC, c_custkey LIMIT 5""")
def calibration_topk(spark, sf_dir):
    """The five largest that qualify (a top-k report)."""
    g = t(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.sum(F.floor("o_totalprice")).alias("census"))
    c = t(spark, sf_dir, "customer").join(g, F.col("o_custkey") == F.col("c_custkey"))
    return catalogue.calibration(c, "census", 1_000_000, 5, "c_custkey").select("c_custkey", "census", F.greatest("census", (F.col("c_custkey") * 1000).cast("long")).alias("order_bytes"))


@query("""WITH b AS (SELECT l_orderkey AS unit, count(*) AS landed, bool_or(l_linenumber = 2) AS marker FROM lineitem GROUP BY 1), u AS (SELECT o_orderkey AS unit, CASE o_orderstatus WHEN 'F' THEN 'ok' WHEN 'O' THEN 'skipped-complete' ELSE 'failed' END AS status, o_orderkey % 5 AS staged FROM orders) SELECT unit, status, staged, coalesce(landed, 0) AS landed, CASE WHEN status = 'failed' THEN 'failed' WHEN NOT coalesce(marker, false) THEN 'missing-marker' WHEN staged > 0 AND coalesce(landed, 0) < staged THEN 'short' WHEN staged > 0 AND landed > staged THEN 'stale-extra' ELSE 'ok' END AS result FROM u LEFT JOIN b USING (unit)""")
def unit_verify(spark, sf_dir):
    """E17 to E20, R11."""
    o = t(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "ok").when(F.col("o_orderstatus") == "O", "skipped-complete").otherwise("failed")
    units = o.select(F.col("o_orderkey").alias("unit"), status.alias("status"), (F.col("o_orderkey") % 5).alias("staged"))
    parts = t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("unit"), (F.col("l_linenumber") == 2).alias("is_marker"), F.lit(1).alias("size"))
    return diff.unit_check(units, parts)


@query("""WITH c AS (SELECT l_partkey AS id, list(DISTINCT CAST(l_quantity AS BIGINT)) AS sizes FROM lineitem GROUP BY 1), l AS (SELECT p_partkey AS id, CAST(p_size AS BIGINT) AS size FROM part WHERE p_partkey % 3 <> 0) SELECT coalesce(c.id, l.id) AS id, l.size, CASE WHEN c.id IS NULL THEN 'extra' WHEN l.id IS NULL THEN 'missing' WHEN NOT list_contains(sizes, size) THEN 'size-mismatch' ELSE 'ok' END AS state FROM c FULL JOIN l ON c.id = l.id""")
def catalog_verify_sizeset(spark, sf_dir):
    """The landed size must be one of the declared ones."""
    c = t(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("id"), F.col("l_quantity").cast("long").alias("q")).groupBy("id").agg(F.collect_set("q").alias("sizes"))
    return diff.catalogue_check(c, t(spark, sf_dir, "part").where("p_partkey % 3 <> 0").select(F.col("p_partkey").alias("id"), F.col("p_size").cast("long").alias("size")))


@query("SELECT coalesce(a.k, b.k) AS id, CASE WHEN b.k IS NULL THEN 'missing' ELSE 'extra' END AS side FROM (SELECT DISTINCT c_custkey AS k FROM customer) a FULL JOIN (SELECT DISTINCT o_custkey + 100 AS k FROM orders) b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL")
def id_set_difference(spark, sf_dir):
    """Both differences of two id sets."""
    a = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")).distinct()
    b = t(spark, sf_dir, "orders").select((F.col("o_custkey") + 100).alias("id")).distinct()
    return a.join(b, "id", "left_anti").withColumn("side", F.lit("missing")).union(b.join(a, "id", "left_anti").withColumn("side", F.lit("extra")))


@query("SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, n AS orders FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey")
def merge_chunks_by_id(spark, sf_dir):
    """Column chunks of one record, merged by id; later values win."""
    c = t(spark, sf_dir, "customer")
    one = c.select(F.col("c_custkey").alias("id"), F.lit(1).alias("chunk"), F.col("c_name").alias("name"), F.lit("?").alias("segment"), F.lit(None).cast("long").alias("orders"))
    two = c.select(F.col("c_custkey").alias("id"), F.lit(2).alias("chunk"), F.lit(None).cast("string").alias("name"), F.col("c_mktsegment").alias("segment"), F.lit(None).cast("long").alias("orders"))
    n = t(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.count("*").alias("orders")).select("id", F.lit(3).alias("chunk"), F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("segment"), "orders")
    return diff.merged_columns(one.union(two).union(n), "id", "chunk")


@query("SELECT (SELECT count(*) FROM orders) AS extract_rows, (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS walk_rows, (SELECT count(*) FROM orders) - (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS delta")
def bulk_crosscheck(spark, sf_dir):
    """Two extracts' row counts."""
    a = t(spark, sf_dir, "orders").agg(F.count("*").alias("extract_rows"))
    b = t(spark, sf_dir, "lineitem").agg(F.count_distinct("l_orderkey").alias("walk_rows"))
    return a.join(F.broadcast(b)).withColumn("delta", F.col("extract_rows") - F.col("walk_rows"))


@query(f"""WITH {_BLOBS}, k AS (SELECT doc_id, md5(text) AS etag FROM documents), x AS (SELECT b.*, etag FROM b JOIN k USING (doc_id)), c AS (SELECT DISTINCT name, etag, clen FROM x WHERE doc_id % 3 = 0 AND method <> 'stored')
 SELECT CASE WHEN name LIKE '%.zip' THEN 'zip' WHEN name LIKE '%.gz' THEN 'gz' WHEN name LIKE '%.xz' THEN 'xz' WHEN name LIKE '%.parquet' THEN 'parquet' ELSE 'stored' END AS kind, c.name IS NOT NULL AS hit, count(*) AS n FROM x LEFT JOIN c USING (name, etag, clen) GROUP BY 1, 2""")
def cache_join_hit_miss(spark, sf_dir):
    """Reuse by (name, etag, clen)."""
    listing = blobs(spark, sf_dir).join(t(spark, sf_dir, "documents").select("doc_id", F.md5(F.col("text").cast("binary")).alias("etag")), "doc_id")
    cache = listing.where("doc_id % 3 = 0 and method <> 'stored'").dropDuplicates(["name", "etag", "clen"])
    hit = sizing.cached(listing.select("name", "clen", "etag"), cache)
    return hit.groupBy(P.blob_kind(F.col("name")).alias("kind"), "hit").agg(F.count("*").alias("n"))


@query("""WITH r AS (SELECT event_type AS source, count(*) AS blobs FROM events WHERE ts >= TIMESTAMP '2024-01-15' AND event_type <> 'click' GROUP BY 1), p AS (SELECT event_type AS source, count(*) AS blobs FROM events WHERE ts < TIMESTAMP '2024-01-15' GROUP BY 1) SELECT source, blobs, 'measured' AS state FROM r UNION ALL SELECT s.source, p.blobs, CASE WHEN p.blobs IS NULL THEN 'gap' ELSE 'carried' END FROM (VALUES ('click'), ('never')) s(source) LEFT JOIN p ON s.source = p.source""")
def carry_forward(spark, sf_dir):
    """Skipped prefixes keep their previous numbers."""
    e = t(spark, sf_dir, "events")
    agg = lambda df: df.groupBy(F.col("event_type").alias("source")).agg(F.count("*").alias("blobs"), F.count("*").alias("comp"), F.count("*").alias("unc"))
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    skipped = spark.createDataFrame([("click",), ("never",)], "source string")
    return sizing.carried_forward(agg(e.where((F.col("ts") >= cut) & (F.col("event_type") != "click"))), skipped, agg(e.where(F.col("ts") < cut))).select("source", "blobs", "state")


# ---- G: runs over time


@query("SELECT user_id, event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn <= 2")
def latest_runs_n(spark, sf_dir):
    """The last two runs of each entity."""
    e = t(spark, sf_dir, "events").withColumn("o", F.struct("ts", "event_id"))
    return sizing.latest(e, ["user_id"], "o", 2).select("user_id", "event_id", "ts")


@query("SELECT user_id, max(event_id) AS event_id FROM events GROUP BY 1")
def last_row_wins(spark, sf_dir):
    """The last row of each key in an append-only log."""
    return sizing.latest(t(spark, sf_dir, "events").select("user_id", "event_id"), ["user_id"], "event_id").select("user_id", "event_id")


def _daily(spark, sf_dir):
    """Cumulative events of each type at the end of each day."""
    d = t(spark, sf_dir, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    w = Window.partitionBy("event_type").orderBy("day")
    return d.select("event_type", "day", F.col("day").cast("timestamp").alias("at"), F.sum("n").over(w).alias("total"))


_DAILY = "y AS (SELECT event_type, day, CAST(sum(n) OVER (PARTITION BY event_type ORDER BY day) AS BIGINT) AS total FROM (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2))"


@query(f"""WITH {_DAILY}, l AS (SELECT *, lag(day) OVER w AS pd, lag(total) OVER w AS pt FROM y WINDOW w AS (PARTITION BY event_type ORDER BY day)), r AS (SELECT event_type, day, total, CASE WHEN pt IS NOT NULL THEN (total - pt) * 86400.0 / (datediff('day', pd, day) * 86400) END AS per_day FROM l) SELECT event_type, day, total, CAST(per_day AS DOUBLE) AS per_day, CASE WHEN per_day > 0 AND (100000 - total) / per_day <= 3650 THEN CAST((100000 - total) AS DOUBLE) / CAST(per_day AS DOUBLE) END AS days_left FROM r""")
def rate_eta(spark, sf_dir):
    """G1: rate since the previous run and days to the end."""
    r = timeseries.with_previous(_daily(spark, sf_dir), "event_type", "at", "total")
    per_day = timeseries.rate(F.col("total"), F.col("prev_value"), F.unix_timestamp("at") - F.unix_timestamp("prev_ts"))
    return r.withColumn("per_day", per_day.cast("double")).select("event_type", "day", "total", "per_day", timeseries.days_left(F.lit(100000) - F.col("total"), F.col("per_day")).alias("days_left"))


@query(f"""WITH {_DAILY}, l AS (SELECT event_type, max(day) AS day, arg_max(total, day) AS total, arg_min(total, day) AS first, count(*) AS n FROM y GROUP BY 1) SELECT l.event_type, CASE WHEN n > 1 THEN l.total - coalesce((SELECT arg_max(total, day) FROM y WHERE y.event_type = l.event_type AND datediff('day', y.day, l.day) >= 1), first) END AS delta FROM l""")
def delta_asof_20h(spark, sf_dir):
    """Against the newest run at least 20 hours older."""
    return timeseries.as_of_delta(_daily(spark, sf_dir), "event_type", "at", "total")


@query("""WITH y AS (SELECT user_id, CAST(ts AS DATE) AS day, CAST(max(value) * 0 + count(*) // 5 AS BIGINT) AS total FROM events GROUP BY 1, 2), g AS (SELECT *, lag(total) OVER (PARTITION BY user_id ORDER BY day) AS pt FROM y), c AS (SELECT *, max(CASE WHEN pt IS NULL OR total > pt THEN day END) OVER (PARTITION BY user_id ORDER BY day) AS changed FROM g)
 SELECT user_id, day, total, CAST(datediff('day', changed, day) AS BIGINT) AS flat_days, CASE WHEN total < 3 AND datediff('day', changed, day) >= 3 THEN 'stalled' ELSE 'pushing' END AS stage FROM c""")
def stage_transitions(spark, sf_dir):
    """Last growth, flat days and stage after each run."""
    d = t(spark, sf_dir, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.floor(F.count("*") / 5).cast("long").alias("total")).withColumn("at", F.col("day").cast("timestamp"))
    c = timeseries.changes(d, "user_id", "at", "total")
    return c.select("user_id", "day", "total", "flat_days", timeseries.stage(F.col("total") >= 3, F.col("flat_days")).alias("stage"))


@query("""WITH v AS (SELECT doc_id, source AS key, md5(text) AS etag, doc_id = max(doc_id) OVER (PARTITION BY source) AS is_latest FROM documents), c AS (SELECT key, max(etag) FILTER (is_latest) AS current FROM v GROUP BY 1), r AS (SELECT v.*, current, row_number() OVER (PARTITION BY v.key, etag ORDER BY doc_id DESC) AS nth FROM v JOIN c ON v.key = c.key WHERE NOT is_latest) SELECT key, doc_id, etag FROM r WHERE nth = 1 AND etag <> current""")
def version_distinct(spark, sf_dir):
    """Old versions worth keeping; etags are of whole texts."""
    d = t(spark, sf_dir, "documents")
    last = d.groupBy("source").agg(F.max("doc_id").alias("last"))
    v = d.join(F.broadcast(last), "source").select(F.col("source").alias("key"), (-F.col("doc_id")).alias("seq"), "doc_id", F.md5(F.col("text").cast("binary")).alias("etag"), (F.col("doc_id") == F.col("last")).alias("is_latest"))
    return diff.distinct_versions(v).select("key", "doc_id", "etag")


@query("""WITH j AS (SELECT CAST(floor(epoch(ts)) AS BIGINT) AS end_s, 60 AS seconds, event_id % 10 AS files FROM events), n AS (SELECT CAST(max(end_s) AS BIGINT) AS now FROM j), r AS (SELECT j.*, now FROM j, n WHERE end_s >= now - 86400) SELECT CAST(sum(files) AS BIGINT) AS files, CAST(max(now) - min(end_s - seconds) AS BIGINT) AS span, CAST(sum(files) AS DOUBLE) / (max(now) - min(end_s - seconds)) AS per_second FROM r""")
def throughput_window(spark, sf_dir):
    """Rate over a trailing window."""
    j = t(spark, sf_dir, "events").select(F.unix_timestamp(F.col("ts").cast("timestamp")).alias("end_s"), F.lit(60).alias("seconds"), (F.col("event_id") % 10).alias("files"))
    now = j.agg(F.max("end_s").alias("now"))
    return timeseries.trailing_rate(j.join(F.broadcast(now)), F.col("now"), 1440)


@query("""SELECT o_orderkey, CASE WHEN o_orderdate + INTERVAL 14 DAY > TIMESTAMP '1998-01-01' THEN 'active' ELSE 'expired' END AS state, CAST(datediff('day', TIMESTAMP '1998-01-01', o_orderdate + INTERVAL 14 DAY) AS BIGINT) AS days FROM orders""")
def token_view(spark, sf_dir):
    """State and days left at a given time."""
    end = F.col("o_orderdate") + F.expr("interval 14 days")
    now = F.lit("1998-01-01").cast("timestamp_ntz")
    return t(spark, sf_dir, "orders").select("o_orderkey", F.when(end > now, "active").otherwise("expired").alias("state"), F.datediff(end, now).cast("long").alias("days"))


# ---- H: order, top-k, samples


@query("""WITH o AS (SELECT o_orderkey, o_orderpriority, CAST(floor(o_totalprice) AS BIGINT) AS bytes, o_orderkey % 50 = 0 AS calibrate FROM orders WHERE o_orderstatus = 'O'), r AS (SELECT *, row_number() OVER (PARTITION BY calibrate ORDER BY o_orderpriority, bytes DESC, o_orderkey) AS rn FROM o) SELECT o_orderkey, calibrate, rn FROM r WHERE calibrate OR rn <= 100""")
def plan_sites_order(spark, sf_dir):
    """H1, H2: a work order whose limit never drops calibration rows (the limit is the feature)."""
    o = t(spark, sf_dir, "orders").where("o_orderstatus = 'O'").select("o_orderkey", "o_orderpriority", F.floor("o_totalprice").alias("bytes"), (F.col("o_orderkey") % 50 == 0).alias("calibrate"))
    return catalogue.work_order(o, "calibrate", 100, "o_orderpriority", F.desc("bytes"), "o_orderkey").select("o_orderkey", "calibrate", "rn")


@query("""SELECT l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE l_returnflag WHEN 'R' THEN 0 WHEN 'A' THEN 1 ELSE 2 END, l_quantity DESC, l_linenumber) AS rn FROM lineitem) WHERE rn = 1""")
def choose_best(spark, sf_dir):
    """H8: the best candidate by rank, then size, without a window: one aggregation."""
    rank = F.when(F.col("l_returnflag") == "R", 0).when(F.col("l_returnflag") == "A", 1).otherwise(2)
    return catalogue.best(t(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber", rank, -F.col("l_quantity"), "l_linenumber")


@query("""WITH s AS (SELECT source, CAST(sum(n_chars) AS BIGINT) AS bytes FROM documents GROUP BY 1), c AS (SELECT source, source || '/' || lang AS child, CAST(sum(n_chars) AS BIGINT) AS bytes FROM documents WHERE lang <> 'en' GROUP BY 1, 2) SELECT source, child, bytes FROM c UNION ALL SELECT s.source, '(other)', s.bytes - coalesce(z.bytes, 0) FROM s LEFT JOIN (SELECT source, CAST(sum(bytes) AS BIGINT) AS bytes FROM c GROUP BY 1) z USING (source)""")
def unexpected_breakdown(spark, sf_dir):
    """H6: children of each unexpected source and the remainder."""
    d = t(spark, sf_dir, "documents")
    s = d.groupBy("source").agg(F.sum("n_chars").alias("bytes"))
    c = d.where("lang <> 'en'").groupBy("source", F.concat_ws("/", "source", "lang").alias("child")).agg(F.sum("n_chars").alias("bytes"))
    z = c.groupBy("source").agg(F.sum("bytes").alias("known"))
    rest = s.join(z, "source", "left").select("source", F.lit("(other)").alias("child"), (F.col("bytes") - F.coalesce("known", F.lit(0))).alias("bytes"))
    return c.union(rest)


@query("SELECT DISTINCT source FROM documents")
def list_top_level(spark, sf_dir):
    """Distinct top-level prefixes."""
    return t(spark, sf_dir, "documents").select("source").distinct()


# ---- I, J: arrays, nested values, ledgers


@query(r"""SELECT DISTINCT page_id, unnest(regexp_extract_all(html, '(href|src)="([^"]+)"', 2)) AS url FROM pages""")
def asset_url_extract(spark, sf_dir):
    """Distinct URLs in markup."""
    found = F.array_distinct(F.regexp_extract_all("html", F.lit('(href|src)="([^"]+)"'), F.lit(2)))
    return t(spark, sf_dir, "pages").select("page_id", F.explode(found).alias("url"))


@query("""SELECT event_id, k AS key, json_extract_string(props, '$."' || k || '"') AS value FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events) WHERE k <> 'zz'""")
def dynamic_key_map(spark, sf_dir):
    """Every key of a JSON object but the excluded ones."""
    m = F.map_filter(F.from_json("props", "map<string,string>"), lambda k, v: k != "zz")
    return t(spark, sf_dir, "events").select("event_id", F.explode(m).alias("key", "value"))


@query("SELECT conv_id, count(*) AS messages, CAST(sum(CASE WHEN turn > 0 THEN 1 ELSE 0 END) AS BIGINT) AS replies, arg_min(text, turn) AS opening FROM conversations GROUP BY 1")
def thread_completion(spark, sf_dir):
    """Threads put together from pages of replies; replies are counted, not gathered."""
    c = t(spark, sf_dir, "conversations")
    return c.groupBy("conv_id").agg(F.count("*").alias("messages"), F.sum(F.when(F.col("turn") > 0, 1).otherwise(0)).alias("replies"), F.min_by("text", "turn").alias("opening"))


@query("""WITH f AS (SELECT md5(text) AS id, doc_id, source, n_chars FROM documents), o AS (SELECT *, min(doc_id) OVER (PARTITION BY id) AS owner FROM f) SELECT id, doc_id, source, CASE WHEN doc_id = owner THEN 'object' ELSE 'share' END AS part FROM o""")
def ledger_first_sighting(spark, sf_dir):
    """The first sighting owns a file; later ones are shares."""
    f = t(spark, sf_dir, "documents").select(F.md5(F.col("text").cast("binary")).alias("id"), "doc_id", "source")
    return catalogue.first_sightings(f, "id", "doc_id").select("id", "doc_id", "source", "part")


@query("""WITH l AS (SELECT doc_id AS blob, CASE WHEN doc_id % 10 = 0 THEN 0 ELSE n_chars END AS size, ['copied','present','failed'][doc_id % 3 + 1] AS status FROM documents), d AS (SELECT doc_id AS blob, CASE WHEN doc_id % 20 = 0 THEN 0 WHEN doc_id % 17 = 0 THEN n_chars + 1 ELSE n_chars END AS bytes FROM documents WHERE doc_id % 13 <> 0), w AS (SELECT * FROM l WHERE status <> 'failed')
 SELECT coalesce(w.blob, d.blob) AS blob, size, bytes, CASE WHEN status IS NULL THEN 'unexpected' WHEN bytes IS NULL THEN 'missing' WHEN size > 0 AND size <> bytes THEN 'mismatch' WHEN size = 0 AND bytes = 0 THEN 'zero-length' ELSE 'ok' END AS state FROM w FULL JOIN d ON w.blob = d.blob""")
def ledger_verify(spark, sf_dir):
    """E7, R13, S28."""
    d = t(spark, sf_dir, "documents")
    i = F.col("doc_id")
    status = F.element_at(F.array(*map(F.lit, ("copied", "present", "failed"))), (i % 3 + 1).cast("int"))
    ledger = d.select(i.alias("blob"), F.when(i % 10 == 0, 0).otherwise(F.col("n_chars")).alias("size"), status.alias("status"))
    landed = d.where("doc_id % 13 <> 0").select(i.alias("blob"), F.when(i % 20 == 0, 0).when(i % 17 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars")).alias("bytes"))
    return diff.ledger_check(ledger, landed)


_TREE = """SELECT 'r' || CAST(r_regionkey AS VARCHAR) AS id, CAST(NULL AS VARCHAR) AS parent, r_name AS name FROM region UNION ALL SELECT 'n' || CAST(n_nationkey AS VARCHAR), 'r' || CAST(n_regionkey AS VARCHAR), n_name FROM nation UNION ALL SELECT 's' || CAST(s_suppkey AS VARCHAR), 'n' || CAST(s_nationkey AS VARCHAR), s_name FROM supplier"""


@query(f"""WITH RECURSIVE e AS ({_TREE}), w AS (SELECT id, name AS path, 0 AS depth FROM e WHERE parent IS NULL UNION ALL SELECT e.id, w.path || '/' || e.name, w.depth + 1 FROM e JOIN w ON e.parent = w.id WHERE w.depth < 20) SELECT id, path, CAST(depth AS BIGINT) AS depth FROM w""")
def tree_flatten(spark, sf_dir):
    """Folder paths of a tree, to a depth of 20, by a recursive query."""
    r, n, s = (t(spark, sf_dir, x) for x in ("region", "nation", "supplier"))
    edges = r.select(F.concat(F.lit("r"), "r_regionkey").alias("id"), F.lit(None).cast("string").alias("parent"), F.col("r_name").alias("name"))
    edges = edges.union(n.select(F.concat(F.lit("n"), "n_nationkey"), F.concat(F.lit("r"), "n_regionkey"), "n_name")).union(s.select(F.concat(F.lit("s"), "s_suppkey"), F.concat(F.lit("n"), "s_nationkey"), "s_name"))
    return catalogue.flattened(edges)


# ---- F, N: outcomes, verdicts, notes


@query("""WITH g AS (SELECT n_name, CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS received, CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE CAST(50000000 AS BIGINT) END AS declared FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name, n_nationkey) SELECT count(*) AS entities, CAST(sum(coalesce(declared, 0)) AS BIGINT) AS declared, CAST(sum(CASE WHEN declared IS NOT NULL THEN received END) AS BIGINT) AS received, CAST(sum(CASE WHEN declared IS NOT NULL THEN received END) AS DOUBLE) * 100 / CAST(sum(declared) AS DOUBLE) AS pct FROM g""")
def fleet_dashboard(spark, sf_dir):
    """totals over entities; received counts only where a manifest exists."""
    o = t(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.sum(F.floor("o_totalprice")).alias("p"))
    g = o.join(t(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).groupBy("c_nationkey").agg(F.sum("p").alias("received"))
    g = g.withColumn("declared", F.when(F.col("c_nationkey") % 4 != 0, F.lit(50000000).cast("long")))
    return catalogue.fleet_totals(g)


@query("""WITH s AS (SELECT c_nationkey, c_mktsegment, count(*) AS actual FROM customer GROUP BY 1, 2), v AS (SELECT c_nationkey, bool_and(actual * 100 >= 98 * 10) AS services_ok, sum(actual) * 100 >= 98 * 55 AS headline_ok FROM s GROUP BY 1) SELECT c_nationkey, CASE WHEN c_nationkey % 6 = 0 THEN 'cannot-verify' WHEN services_ok AND headline_ok THEN 'complete' ELSE 'incomplete' END AS verdict FROM v""")
def verdict(spark, sf_dir):
    """The conjunction of hard checks."""
    s = t(spark, sf_dir, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("actual"))
    v = s.groupBy("c_nationkey").agg(F.bool_and(F.col("actual") * 100 >= 98 * 10).alias("services_ok"), (F.sum("actual") * 100 >= 98 * 55).alias("headline_ok"))
    return v.select("c_nationkey", reconcile.verdict(F.col("c_nationkey") % 6 != 0, F.lit(True), F.col("headline_ok"), F.col("services_ok"), F.lit(None).cast("boolean"), F.lit(True)).alias("verdict"))


@query("""SELECT o_orderpriority AS kind, count(*) FILTER (o_orderstatus = 'P') AS failed, count(*) FILTER (o_orderstatus = 'O') AS skipped, CAST(coalesce(sum(CAST(floor(o_totalprice) AS BIGINT)) FILTER (o_orderstatus <> 'P'), 0) AS BIGINT) AS staged, bool_or(o_orderstatus = 'P') AS any_failed FROM orders GROUP BY 1""")
def run_manifest_partition(spark, sf_dir):
    """Outcomes of a run's units by kind."""
    s, b = F.col("o_orderstatus"), F.floor("o_totalprice")
    return t(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("kind")).agg(F.count_if(s == "P").alias("failed"), F.count_if(s == "O").alias("skipped"), F.coalesce(F.sum(F.when(s != "P", b)), F.lit(0)).alias("staged"), F.bool_or(s == "P").alias("any_failed"))


@query("""SELECT l_suppkey AS module, count(*) AS files, CAST(sum(coalesce(TRY_CAST(CASE WHEN l_linenumber = 7 THEN 'n/a' ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS BIGINT), 0)) AS BIGINT) AS bytes FROM lineitem GROUP BY 1 ORDER BY bytes DESC, module LIMIT 15""")
def attachment_census(spark, sf_dir):
    """Files and bytes by module, sizes that are no numbers count 0 (a top-k report)."""
    size = F.when(F.col("l_linenumber") == 7, "n/a").otherwise(F.col("l_quantity").cast("long").cast("string"))
    g = t(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("module")).agg(F.count("*").alias("files"), F.sum(F.coalesce(size.try_cast("long"), F.lit(0))).alias("bytes"))
    return g.orderBy(F.desc("bytes"), "module").limit(15)


@query("""WITH g AS (SELECT source, CAST(sum(n_chars) AS BIGINT) AS comp, CAST(sum(n_chars) * 101 // 100 AS BIGINT) AS unc FROM documents GROUP BY 1) SELECT source, CASE WHEN unc BETWEEN 0.9 * comp AND 1.02 * comp THEN 'store-mode' ELSE '' END || CASE WHEN comp >= 100000 THEN ';large' ELSE '' END AS notes FROM g""")
def rule_notes(spark, sf_dir):
    """Rules as predicates with texts."""
    g = t(spark, sf_dir, "documents").groupBy("source").agg(F.sum("n_chars").alias("comp")).withColumn("unc", F.floor(F.col("comp") * 101 / 100))
    ratio = F.try_divide("unc", "comp")
    return g.select("source", F.concat(F.when(ratio.between(0.9, 1.02), "store-mode").otherwise(""), F.when(F.col("comp") >= 100000, ";large").otherwise("")).alias("notes"))


# ---- L, M: dates, plans, estimates


@query("""SELECT o_custkey, CAST(greatest(m, s) AS DATE) AS from_day, CAST(least(last_day(m), e) AS DATE) AS to_day FROM (SELECT o_custkey, s, e, CAST(unnest(generate_series(date_trunc('month', s), e, INTERVAL 1 MONTH)) AS DATE) AS m FROM (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS s, CAST(max(o_orderdate) AS DATE) AS e FROM orders GROUP BY 1))""")
def month_windows(spark, sf_dir):
    """Calendar months clipped to a span."""
    o = t(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min(F.to_date("o_orderdate")).alias("s"), F.max(F.to_date("o_orderdate")).alias("e"))
    return timeseries.month_windows(o, "s", "e").select("o_custkey", "from_day", "to_day")


@query("""WITH s AS (SELECT lang, count(*) AS total, count(*) FILTER (doc_id % 4 = 0) AS taken, coalesce(sum(n_chars) FILTER (doc_id % 4 = 0), 0) AS bytes FROM documents GROUP BY 1) SELECT lang, total, taken, CAST(round_even(CAST(bytes AS DOUBLE) * (CAST(total AS DOUBLE) / taken), 0) AS BIGINT) AS estimate FROM s""")
def scale_census(spark, sf_dir):
    """A sample's bytes scaled to the whole (the sample is the feature)."""
    s = t(spark, sf_dir, "documents").groupBy("lang").agg(F.count("*").alias("total"), F.count_if(F.col("doc_id") % 4 == 0).alias("taken"), F.coalesce(F.sum(F.when(F.col("doc_id") % 4 == 0, F.col("n_chars"))), F.lit(0)).alias("bytes"))
    return s.select("lang", "total", "taken", planning.scaled(F.col("bytes"), F.col("total"), F.col("taken")).alias("estimate"))


@query("""WITH g AS (SELECT event_type, count(*) AS objects FROM events GROUP BY 1) SELECT event_type, objects, CAST(objects AS DOUBLE) / least(16.0 / 2.5, 5.0) AS seconds, CAST(objects AS DOUBLE) / 13.5 / 60.0 AS hours_raw FROM g""")
def estimate_runtime(spark, sf_dir):
    """M2 to M4: how long a copy takes under a latency and a ceiling."""
    g = t(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("objects"))
    return g.select("event_type", "objects", planning.runtime_seconds(F.col("objects"), F.lit(2.5), 16, 5.0).alias("seconds"), (F.col("objects").cast("double") / (planning.PLAN_LIMITS["pro"] * planning.SAFETY) / 60.0).alias("hours_raw"))


@query("""WITH k AS (SELECT source || '/' || lang || '/' || CAST(doc_id AS VARCHAR) AS k FROM documents) SELECT string_split(k, '/')[1] || '/' AS prefix, count(*) AS objects, CAST(1 AS BIGINT) AS depth, 'R' AS type FROM k GROUP BY 1""")
def plan_jobs(spark, sf_dir):
    """M5: a job for each prefix at the depth that gives enough but not too many."""
    k = t(spark, sf_dir, "documents").select(F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")).alias("k"))
    return planning.job_plan(k, "k", 4, 1000).select("prefix", "objects", F.col("depth").cast("long").alias("depth"), "type")


@query(r"""WITH k AS (SELECT p_name || CAST(p_partkey AS VARCHAR) AS k FROM part), r AS (SELECT k, CASE WHEN regexp_matches(k, '^[0-9A-Za-z._/-]+$') THEN 'chunk' ELSE 'quarantine' END AS kind FROM k) SELECT k, kind || '-' || lpad(CAST((row_number() OVER (PARTITION BY kind ORDER BY k) - 1) // 100 AS VARCHAR), 5, '0') AS chunk FROM r""")
def split_chunks(spark, sf_dir):
    """Keys dealt to numbered chunks, unsafe ones apart."""
    k = t(spark, sf_dir, "part").select(F.concat("p_name", F.col("p_partkey").cast("string")).alias("k"))
    return planning.chunks(k, "k", 100)


@query("""SELECT doc_id, b AS block, b * 1000 AS start, least((b + 1) * 1000, n_chars) - 1 AS "end" FROM (SELECT doc_id, n_chars, unnest(generate_series(0, (n_chars - 1) // 1000)) AS b FROM documents WHERE n_chars > 0)""")
def block_plan(spark, sf_dir):
    """Byte ranges that cover each size."""
    return planning.blocks(t(spark, sf_dir, "documents").select("doc_id", "n_chars"), "n_chars", 1000).where("not refused").select("doc_id", F.col("block").cast("long").alias("block"), "start", "end")


@query("""SELECT CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 4))::INT // 4096 AS BIGINT) AS shard, count(*) AS n FROM (SELECT * FROM documents) GROUP BY 1""")
def range_shards(spark, sf_dir):
    """Keys by range."""
    key = F.md5(F.col("doc_id").cast("string").cast("binary"))
    return t(spark, sf_dir, "documents").groupBy(planning.shard(key, 16).cast("long").alias("shard")).agg(F.count("*").alias("n"))


@query("""WITH RECURSIVE i AS (SELECT doc_id, n_chars, row_number() OVER (ORDER BY doc_id) AS rn FROM documents WHERE n_chars <= 20000 AND n_chars > 0), f AS (SELECT CAST(0 AS BIGINT) AS rn, CAST(0 AS BIGINT) AS used, CAST(NULL AS BIGINT) AS doc_id UNION ALL SELECT i.rn, CASE WHEN f.used + i.n_chars <= 20000 THEN f.used + i.n_chars ELSE f.used END, CASE WHEN f.used + i.n_chars <= 20000 THEN i.doc_id END FROM f JOIN i ON i.rn = f.rn + 1) SELECT doc_id FROM f WHERE doc_id IS NOT NULL""")
def greedy_budget(spark, sf_dir):
    """Admission under a budget, in order of id."""
    return sizing.admitted(t(spark, sf_dir, "documents").select("doc_id", "n_chars"), 20000, "doc_id", "n_chars").select("doc_id")


# ---- K, O: archives and folds


@query("""SELECT 'd' || CAST(doc_id AS VARCHAR) || CASE WHEN doc_id % 2 = 1 THEN '.gz' ELSE '.zip' END AS path, CAST(strlen(text) AS BIGINT) AS uncomp, CASE WHEN doc_id % 2 = 1 THEN 'gz' ELSE 'zip' END AS kind, CASE WHEN doc_id % 2 = 1 THEN 'gz-exact' ELSE 'zip-exact' END AS method FROM documents""")
def archive_sizes(spark, sf_dir):
    """Sizes of archives made of the documents, read through."""
    import gzip
    import io
    import zipfile

    import pandas as pd

    from ..operators import binary

    def make(batches):
        for df in batches:
            rows = []
            for i, text in zip(df["doc_id"], df["text"], strict=True):
                data = text.encode()
                if i % 2:
                    rows.append((f"d{i}.gz", gzip.compress(data)))
                else:
                    with zipfile.ZipFile(held := io.BytesIO(), "w", zipfile.ZIP_DEFLATED) as z:
                        z.writestr("text.txt", data)
                    rows.append((f"d{i}.zip", held.getvalue()))
            yield pd.DataFrame(rows, columns=["path", "content"])

    files = t(spark, sf_dir, "documents").select("doc_id", "text").mapInPandas(make, "path string, content binary")
    return binary.sized(files, deep=True).drop("clen")


@query()
def aimd_rate(spark, sf_dir):
    """The pace that each user's events lead to, errors as throttles."""
    from ..streaming.incremental import pace

    e = t(spark, sf_dir, "events")
    return pace(e.select(F.col("user_id").alias("key"), F.unix_timestamp(F.col("ts").cast("timestamp")).cast("double").alias("second"), (F.col("event_type") == "error").alias("throttle")))


@query("""SELECT CAST(time_bucket(INTERVAL 30 MINUTE, ts) AS TIMESTAMP) AS start, event_type, count(*) AS n, CAST(sum(event_id % 10) AS BIGINT) AS size FROM events GROUP BY 1, 2""")
def stream_throughput(spark, sf_dir):
    """O: the batch form of the streaming window, by the same function."""
    from ..streaming.incremental import throughput

    e = t(spark, sf_dir, "events").select(F.col("ts").alias("at"), "event_type", (F.col("event_id") % 10).alias("size"))
    return throughput(e).withColumn("start", F.col("start").cast("timestamp_ntz"))
