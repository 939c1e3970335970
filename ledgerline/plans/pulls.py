"""Queries over pulls, probes, fleets and notes, one for each method, each beside its SQL.

Importing this module completes the registry of plans.landed.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import decisions as D
from ..functions import paths as P
from ..functions import services as S
from ..operators import outcomes as O
from ..operators import planning, pulls, reconcile, timeseries
from ..sources import readers as R
from .landed import pick
from .queries import QUERIES, SQL, blobs, query, t

__all__ = ["QUERIES", "SQL"]

# ---- A: listings and relations


@query("""WITH n AS (SELECT p_brand || '/' || p_type || '/' || CAST(p_partkey AS VARCHAR) AS name FROM part), u AS (SELECT 'Brand#1' || string_split(substr(name, 8), '/')[1] || '/' AS entry FROM n WHERE starts_with(name, 'Brand#1') AND name > 'Brand#12')
 SELECT entry, count(*) AS n, TRUE AS is_prefix FROM u GROUP BY 1 ORDER BY 1 LIMIT 5000""")
def listing_pushdown(spark, sf_dir):
    """A10: a listing's page by prefix, marker and delimiter."""
    n = t(spark, sf_dir, "part").select(F.concat_ws("/", "p_brand", "p_type", F.col("p_partkey").cast("string")).alias("name"))
    return R.list_page(n, "name", "Brand#1", "Brand#12", "/")


def _deliveries(spark, sf_dir):
    k = F.col("o_orderkey")
    name = F.concat(F.lit("in/"), F.when(k % 11 == 0, "").otherwise(F.col("o_orderpriority")), F.when(k % 13 == 0, "").otherwise("/"), F.when(k % 17 == 0, "").otherwise(F.concat(F.lit("f/"), k.cast("string"))))
    return t(spark, sf_dir, "orders").select(k, F.when(k % 7 == 0, F.concat(F.lit("x"), name)).otherwise(name).alias("name"), (k % 100).alias("size"))


_DELIVERIES = "l AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'x' ELSE '' END || 'in/' || CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE o_orderpriority END || CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE '/' END || CASE WHEN o_orderkey % 17 = 0 THEN '' ELSE 'f/' || CAST(o_orderkey AS VARCHAR) END AS name, o_orderkey % 100 AS size FROM orders)"


@query(f"WITH {_DELIVERIES} SELECT o_orderkey, substr(name, 4) AS key, size FROM l WHERE name LIKE 'in/%' AND length(name) > 3")
def relative_keys(spark, sf_dir):
    """A listing's rows under a prefix, with relative keys."""
    return R.relative(_deliveries(spark, sf_dir), "in/").select("o_orderkey", "key", "size")


@query(f"WITH {_DELIVERIES}, k AS (SELECT substr(name, 4) AS key, size FROM l WHERE name LIKE 'in/%' AND contains(substr(name, 4), '/')), f AS (SELECT string_split(key, '/')[1] AS folder, substr(key, strpos(key, '/') + 1) AS rel, size FROM k) SELECT folder, rel, size FROM f WHERE folder <> '' AND rel <> ''")
def folder_index(spark, sf_dir):
    """(folder, rest, size) of a destination; rows without either are skipped."""
    return R.by_folder(_deliveries(spark, sf_dir), "in/")


@query("""SELECT 'teams' AS relation, CAST(n_nationkey AS VARCHAR) AS id, NULL AS parent, 'ok' AS status FROM nation UNION ALL SELECT 'channels', CAST(c_custkey AS VARCHAR), CAST(c_nationkey AS VARCHAR), 'ok' FROM customer UNION ALL SELECT 'users', CAST(s_suppkey AS VARCHAR), NULL, 'ok' FROM supplier
 UNION ALL SELECT 'team_members', CAST(s_suppkey AS VARCHAR), CAST(s_nationkey AS VARCHAR), CASE WHEN s_nationkey % 6 = 5 THEN 'refused' ELSE 'ok' END FROM supplier UNION ALL SELECT 'channel_members', CAST(o_orderkey AS VARCHAR), CAST(c_custkey AS VARCHAR), CASE WHEN c_custkey % 9 = 4 THEN 'refused' ELSE 'ok' END FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment <> 'BUILDING'""")
def directory_relations(spark, sf_dir):
    """Teams, channels, users and both kinds of members with their parents; members only of other than standard channels; refusals are rows."""
    ok = F.lit("ok").alias("status")
    none = F.lit(None).cast("long").alias("parent")
    c, s = t(spark, sf_dir, "customer"), t(spark, sf_dir, "supplier")
    private = c.where("c_mktsegment <> 'BUILDING'")
    members = t(spark, sf_dir, "orders").join(private, F.col("o_custkey") == F.col("c_custkey"))
    return pulls.relations(
        teams=t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), none, ok),
        channels=c.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("parent"), ok),
        users=s.select(F.col("s_suppkey").alias("id"), none, ok),
        team_members=s.select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("parent"), F.when(F.col("s_nationkey") % 6 == 5, "refused").otherwise("ok").alias("status")),
        channel_members=members.select(F.col("o_orderkey").alias("id"), F.col("c_custkey").alias("parent"), F.when(F.col("c_custkey") % 9 == 4, "refused").otherwise("ok").alias("status")),
    )


_LEGS = ["issues", "pulls", "issue_comments", "review_comments"]


@query("""WITH r AS (SELECT o_custkey AS repo, ['issues','pulls','issue_comments','review_comments'][o_orderkey % 4 + 1] AS leg FROM orders), w AS (SELECT c_custkey AS repo, leg, CASE WHEN (c_custkey + length(leg)) % 5 = 0 THEN 404 WHEN (c_custkey + length(leg)) % 7 = 0 THEN 403 ELSE 200 END AS http FROM customer, (SELECT unnest(['issues','pulls','issue_comments','review_comments']) AS leg)), c AS (SELECT repo, leg, count(*) AS n FROM r GROUP BY 1, 2)
 SELECT repo, leg, CASE WHEN http = 200 THEN coalesce(n, 0) ELSE 0 END AS n, CASE http WHEN 200 THEN 'ok' WHEN 404 THEN 'off' ELSE 'unavailable-403' END AS status FROM w LEFT JOIN c USING (repo, leg)""")
def repository_relations(spark, sf_dir):
    """Four relations of each unit; a leg that is off counts 0, a refused one keeps its status."""
    units = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("repo"))
    rows = t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("repo"), pick(F.col("o_orderkey"), *_LEGS).alias("leg"))
    x = F.col("repo") + F.length("leg")
    return pulls.legs(units, "repo", rows, _LEGS, F.when(x % 5 == 0, 404).when(x % 7 == 0, 403).otherwise(200))


@query("""WITH p AS (SELECT p_partkey AS repo, p_size, p_partkey % 2 = 0 AS private, p_partkey % 5 = 0 AS archived, p_partkey % 3 = 0 AS fork, p_type, CASE WHEN p_brand < 'Brand#3' THEN 'org' ELSE 'user' END AS owner FROM part), s AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY owner ORDER BY repo) AS rn FROM p) WHERE rn <= 50)
 SELECT owner, count(*) AS repos, count(*) FILTER (private) AS private, count(*) FILTER (archived) AS archived, count(*) FILTER (fork) AS forks, CAST(sum(p_size) * 1024 AS BIGINT) AS bytes, (SELECT count(*) FILTER (contains(p_type, 'BRASS')) FROM s WHERE s.owner = p.owner) AS lfs FROM p GROUP BY owner""")
def repository_catalogue(spark, sf_dir):
    """A catalogue by owner type: private, archived and forked repositories, bytes, and large-file use among the first 50 (a probe's sample)."""
    k = F.col("p_partkey")
    p = t(spark, sf_dir, "part").select(k, "p_size", "p_type", F.when(F.col("p_brand") < "Brand#3", "org").otherwise("user").alias("owner"))
    first = None
    for owner in ("org", "user"):
        some = pulls.first_matching(p.where(F.col("owner") == owner), "p_partkey", 50, F.contains("p_type", F.lit("BRASS"))).select(F.lit(owner).alias("owner"), F.col("matching").alias("lfs"))
        first = some if first is None else first.union(some)
    g = p.groupBy("owner").agg(F.count("*").alias("repos"), F.count_if(k % 2 == 0).alias("private"), F.count_if(k % 5 == 0).alias("archived"), F.count_if(k % 3 == 0).alias("forks"), (F.sum("p_size") * 1024).cast("long").alias("bytes"))
    return g.join(first, "owner")


@query("""WITH f AS (SELECT date_trunc('month', o_orderdate) AS month, o_orderpriority AS kind, o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '1997-03-01' AS pullable, o_orderkey % 4 = 0 AS placeholder FROM orders), n AS (SELECT * FROM f WHERE month > TIMESTAMP '1996-06-01' AND month <= TIMESTAMP '1998-06-01'), m AS (SELECT max(month) AS m FROM n WHERE pullable)
 SELECT CAST(month AS DATE) AS month, kind, count(*) AS n, count(*) FILTER (placeholder) AS placeholders FROM n, m WHERE month = m GROUP BY 1, 2""")
def latest_month_probe(spark, sf_dir):
    """The latest of 24 months with a pullable file, its types and placeholders."""
    o = t(spark, sf_dir, "orders")
    f = o.select(F.trunc(F.col("o_orderdate"), "MM").alias("month"), F.col("o_orderpriority").alias("kind"), ((F.col("o_orderstatus") == "F") & (F.col("o_orderdate") < F.lit("1997-03-01").cast("timestamp_ntz"))).alias("pullable"), (F.col("o_orderkey") % 4 == 0).alias("placeholder"))
    return pulls.latest_month(f, F.lit("1998-06-15").cast("date"))


@query("""SELECT 'v' || CAST(p_partkey AS VARCHAR) AS video, p_size AS page FROM part WHERE p_type LIKE '%STEEL%' ORDER BY p_size, p_partkey LIMIT 40""")
def catalogue_limit(spark, sf_dir):
    """A paged catalogue's first videos that are accepted (the limit is asked for)."""
    v = t(spark, sf_dir, "part").where(F.contains("p_type", F.lit("STEEL"))).orderBy("p_size", "p_partkey").limit(40)
    return v.select(F.concat(F.lit("v"), F.col("p_partkey").cast("string")).alias("video"), F.col("p_size").alias("page"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 1 THEN 't' || CAST(c_custkey AS VARCHAR) || '-' || i END AS id, CASE WHEN c_custkey % 3 = 1 THEN '2026-0' || i END AS expires FROM customer, (SELECT unnest(['1', '2']) AS i) WHERE c_custkey % 3 = 1 OR i = '1'""")
def token_ledgers(spark, sf_dir):
    """Token records of each entity; a missing or broken ledger is empty."""
    c = t(spark, sf_dir, "customer").select("c_custkey")
    k = F.col("c_custkey")
    record = [F.concat(F.lit('{"id":"t'), k.cast("string"), F.lit(f'-{i}","expires":"2026-0{i}"}}')) for i in (1, 2)]
    body = F.when(k % 3 == 1, F.concat(F.lit('{"tokens":['), record[0], F.lit(","), record[1], F.lit("]}"))).otherwise('{"tokens":')
    return R.token_ledger(c, c.where("c_custkey % 3 <> 2").select("c_custkey", body.alias("body")), "c_custkey")


# ---- B: runs and publishing


@query("""SELECT CASE WHEN p_partkey % 4 = 0 THEN 'run-metadata' ELSE 'unit' END AS class, CASE WHEN p_partkey % 4 = 0 OR p_partkey % 5 = 0 THEN 'second' ELSE 'first' END AS content, count(*) AS files, (SELECT count(*) FROM part) AS written FROM part GROUP BY 1, 2""")
def published_units(spark, sf_dir):
    """Two runs published: units stay as first created, metadata is the second run's; written lines are counted."""
    from ..sources import writers as W

    k = F.col("p_partkey")
    p = t(spark, sf_dir, "part").select(k, F.concat(F.when(k % 4 == 0, "_meta/").otherwise("files/"), k.cast("string")).alias("path"))
    path = W.scratch(spark, "units")
    W.publish(p.where("p_partkey % 5 <> 0").select("path", F.lit("first").alias("content")), path)
    W.publish(p.select("path", F.lit("second").alias("content")), path)
    written = W.write_lines(p, W.scratch(spark, "lines"))
    return W.published(spark, path).groupBy("class", "content").agg(F.count("*").alias("files")).withColumn("written", F.lit(written).cast("long"))


@query("""WITH s AS (SELECT source, count(*) AS blobs, CAST(sum(n_chars) AS BIGINT) AS comp, count(*) FILTER (n_chars < 200) AS small FROM documents GROUP BY 1)
 SELECT source AS slug, blobs, comp, CASE WHEN small > 0 THEN small END AS errors, small > 0 AS verified, CASE WHEN small > 0 THEN comp - small ELSE NULL END AS trusted, coalesce(CASE WHEN small > 0 THEN small END, 0) = 0 AS clean FROM s""")
def run_rows_of_summaries(spark, sf_dir):
    """Run rows of summaries' JSON; what a summary lacks is null; deep ones carry their verification."""
    s = t(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("blobs"), F.sum("n_chars").alias("comp"), F.count_if(F.col("n_chars") < 200).alias("small"))
    deep = F.when(F.col("small") > 0, F.struct((F.col("comp") - F.col("small")).alias("trusted_bytes")))
    summary = s.select("source", F.to_json(F.struct(F.struct("blobs", "comp").alias("totals"), F.when(F.col("small") > 0, F.struct(F.col("small").alias("total"))).alias("errors"), deep.alias("verification"))).alias("body"))
    r = summary.select(F.col("source").alias("slug"), F.from_json("body", "totals struct<blobs:long,comp:long>, errors struct<total:long>, verification struct<trusted_bytes:long>").alias("s"))
    return r.select("slug", "s.totals.blobs", "s.totals.comp", F.col("s.errors.total").alias("errors"), F.col("s.verification").isNotNull().alias("verified"), F.col("s.verification.trusted_bytes").alias("trusted"), (F.coalesce("s.errors.total", F.lit(0)) == 0).alias("clean"))


# ---- C, D: names, tokens, decisions


@query("""SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN n_name WHEN 1 THEN 'Slack Archive' WHEN 2 THEN 'drive' ELSE NULL END AS service FROM supplier JOIN nation ON n_nationkey = s_nationkey""")
def declared_matcher(spark, sf_dir):
    """Declared names come before the catalogue's and keep their spelling."""
    n = t(spark, sf_dir, "nation")
    names = [r["n_name"] for r in n.orderBy("n_nationkey").collect()]  # what a manifest declares: a handful of names
    aliases = S.matcher([*names, "Slack Archive", "drive"])
    s = t(spark, sf_dir, "supplier").join(F.broadcast(n), F.col("n_nationkey") == F.col("s_nationkey"))
    k = F.col("s_suppkey")
    path = F.when(k % 4 == 0, F.concat(F.lit("x/"), F.lower("n_name"), F.lit("/y.bin"))).when(k % 4 == 1, "in/slack-archive/z.zip").when(k % 4 == 2, "Drive/a/b").otherwise("none/of/these")
    return s.select("s_suppkey", S.of_path(path, aliases).alias("service"))


_TOKEN_URLS = "u AS (SELECT page_id, 'https://h/f' || CAST(page_id AS VARCHAR) || ['', '?a=1&token=xoxe-1&b=2', '?t=xoxp-2', '?token=other', '?a=1&t=xoxe-3#part', '?token=plain&t=xoxb-4'][page_id % 6 + 1] AS url FROM pages)"


@query(rf"""WITH {_TOKEN_URLS}, q AS (SELECT *, regexp_extract_all(url, '[?&](token|t)=(xox[^&#]*)', 1) AS ps, regexp_extract_all(url, '[?&](token|t)=(xox[^&#]*)', 2) AS vs, string_split(url, '#') AS h FROM u),
 k AS (SELECT *, string_split(h[1], '?')[1] AS base, list_filter(string_split(coalesce(string_split(h[1], '?')[2], ''), '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(token|t)=xox')) AS kept FROM q)
 SELECT page_id, vs[1] AS token, ps[-1] AS param, base || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END || CASE WHEN len(h) > 1 THEN '#' || h[2] ELSE '' END AS bare FROM k""")
def token_params(spark, sf_dir):
    """The workspace token of a URL, its parameter, and the URL without it."""
    k = F.col("page_id")
    url = F.concat(F.lit("https://h/f"), k.cast("string"), pick(k, "", "?a=1&token=xoxe-1&b=2", "?t=xoxp-2", "?token=other", "?a=1&t=xoxe-3#part", "?token=plain&t=xoxb-4"))
    u = t(spark, sf_dir, "pages").select("page_id", url.alias("url"))
    return u.select("page_id", P.embedded_token(F.col("url")).alias("token"), P.token_param(F.col("url")).alias("param"), P.token_free(F.col("url")).alias("bare"))


@query("""SELECT page_id, 'https://h/f' || CAST(page_id AS VARCHAR) || ['?token=xoxe-9', '?a=1&t=xoxe-9', '?token=xoxp-own', '', '?a=1&token=xoxe-9'][page_id % 5 + 1] AS url FROM pages""")
def token_restored(spark, sf_dir):
    """C20: a token put back under its parameter; URLs with one of their own and empty tokens are left alone."""
    k = F.col("page_id")
    bare = F.concat(F.lit("https://h/f"), k.cast("string"), pick(k, "", "?a=1", "?token=xoxp-own", "", "?a=1"))
    param = F.when(k % 5 == 1, "t").when(k % 5 == 4, "token")
    return t(spark, sf_dir, "pages").select("page_id", P.with_token(bare, param, F.when(k % 5 == 3, "").otherwise("xoxe-9")).alias("url"))


@query("""WITH b AS (SELECT doc_id, ['gz','zip','xz','gz','parquet'][doc_id % 5 + 1] AS kind, ['gz-trailer','zip:3entries','xz-stored','gz-floor','parquet-footer'][doc_id % 5 + 1] AS method, n_chars * 100000 AS clen FROM documents)
 SELECT doc_id, method NOT IN ('parquet-footer') AS stale_deep, kind = 'gz' AND (method = 'gz-floor' OR clen >= 1000000000) AS uncertain FROM b""")
def cached_row_modes(spark, sf_dir):
    """Which cached rows a deep run measures again, and which trailers leave the size uncertain."""
    k = F.col("doc_id")
    b = t(spark, sf_dir, "documents").select(k, pick(k, "gz", "zip", "xz", "gz", "parquet").alias("kind"), pick(k, "gz-trailer", "zip:3entries", "xz-stored", "gz-floor", "parquet-footer").alias("method"), (F.col("n_chars") * 100000).alias("clen"))
    m = F.col("method")
    return b.select("doc_id", D.row_stale(F.col("kind"), m, F.col("clen"), F.col("clen"), deep=True).alias("stale_deep"), D.gz_uncertain(F.col("kind"), m, F.col("clen"), large=1_000_000_000).alias("uncertain"))


@query("""SELECT c_mktsegment AS module, TRUE AS all_of_them, c_mktsegment IN ('BUILDING', 'MACHINERY') AS only_some, FALSE AS none FROM (SELECT DISTINCT c_mktsegment FROM customer)""")
def module_allow_list(spark, sf_dir):
    """An empty allow-list takes all modules, a list those that it names, a flag none."""
    c = F.col("c_mktsegment")
    return t(spark, sf_dir, "customer").select(c).distinct().select(c.alias("module"), D.listed(c, []).alias("all_of_them"), D.listed(c, ["BUILDING", "MACHINERY"]).alias("only_some"), D.listed(c, None).alias("none"))


# ---- E, F: reconciliation and run manifests


@query("""WITH d AS (SELECT n_name AS service, CAST(n_nationkey * 100000 AS BIGINT) AS declared, CASE WHEN n_nationkey % 5 = 4 THEN n_nationkey END AS records, CASE WHEN n_nationkey % 4 = 3 THEN n_nationkey * 50000 END AS equivalent, CASE WHEN n_nationkey % 6 = 5 THEN 'nowhere/' || n_name WHEN n_nationkey % 6 = 4 THEN 'in/' || n_name END AS pin FROM nation),
 a AS (SELECT n_name AS service, n_nationkey AS k, count(*) AS blobs, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS actual FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey WHERE n_nationkey % 7 <> 3 GROUP BY 1, 2),
 r AS (SELECT d.service, declared, records, CASE WHEN pin LIKE 'nowhere%' THEN 0 ELSE coalesce(actual, 0) END AS actual, coalesce(CASE WHEN n_nationkey % 3 = 0 THEN n_nationkey * 1000 END, 0) AS found, equivalent FROM d LEFT JOIN a USING (service) JOIN nation ON n_name = d.service),
 f AS (SELECT *, records IS NULL AND declared > 0 AS by_bytes, actual = 0 AND found > 0 AS embedded, nullif(equivalent, 0) AS eq FROM r),
 p AS (SELECT *, CASE WHEN records IS NULL AND declared > 0 THEN CASE WHEN embedded THEN found WHEN eq IS NOT NULL AND actual > 0 THEN eq ELSE actual END * 100.0 / declared END AS pct FROM f)
 SELECT service, declared, actual, found, concat_ws(',', CASE WHEN records IS NOT NULL THEN 'record-count' END, CASE WHEN records IS NULL AND declared = 0 AND actual > 0 THEN 'zero-declared-has-data' END, CASE WHEN by_bytes AND eq IS NOT NULL AND actual > 0 THEN 'unit-adjusted' END, CASE WHEN (records IS NOT NULL OR by_bytes) AND embedded THEN 'found-embedded' END, CASE WHEN by_bytes AND actual = 0 AND NOT embedded THEN 'declared-empty' END, CASE WHEN by_bytes AND pct > 100 AND NOT (eq IS NOT NULL AND actual > 0) THEN 'overshoot' END) AS flags FROM p""")
def service_rows_full(spark, sf_dir):
    """Pins in place of names, services detected inside archives (one of two spellings counts), record units, re-expressed sizes."""
    n, k = t(spark, sf_dir, "nation"), F.col("n_nationkey")
    pin = F.when(k % 6 == 5, F.array(F.concat(F.lit("nowhere/"), "n_name"))).when(k % 6 == 4, F.array(F.concat(F.lit("in/"), "n_name")))
    services = n.select(F.col("n_name").alias("service"), (k * 100000).cast("long").alias("declared"), F.when(k % 5 == 4, k).cast("long").alias("records"), pin.alias("prefix"), F.when(k % 4 == 3, k * 50000).cast("long").alias("equivalent"))
    l = t(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("blobs"), F.sum(F.col("l_quantity").cast("long")).alias("unc"))
    l = l.join(t(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(F.broadcast(n.where("n_nationkey % 7 <> 3")), F.col("s_nationkey") == k)
    sources = l.groupBy(F.concat(F.lit("in/"), "n_name").alias("source")).agg(F.sum("blobs").alias("blobs"), F.sum("unc").alias("unc")).withColumn("deduplicated", F.lit(0).cast("long"))
    found = n.where("n_nationkey % 3 = 0").select("n_name", (k * 1000).cast("long").alias("bytes"))
    found = found.select(F.col("n_name").alias("service"), "bytes").union(found.select(F.lower("n_name"), "bytes"))
    rows = reconcile.service_rows(services, sources, found)
    return rows.select("service", "declared", "actual", "found", F.array_join("flags", ",").alias("flags"))


@query("""SELECT s_nationkey AS collection, count(*) AS sites, string_agg(CAST(s_suppkey AS VARCHAR), ',' ORDER BY CAST(s_suppkey AS VARCHAR)) AS ids, string_agg(s_name, ',' ORDER BY s_name) AS names, s_nationkey % 8 <> 7 AS complete FROM supplier WHERE s_suppkey % 9 <> 0 GROUP BY 1""")
def collection_sites(spark, sf_dir):
    """Each collection's sites, personal ones left out; a collection with a page that broke off isn't complete."""
    s = t(spark, sf_dir, "supplier").where("s_suppkey % 9 <> 0")
    broken = t(spark, sf_dir, "nation").where("n_nationkey % 8 = 7").select(F.col("n_nationkey").alias("collection"), F.lit(True).alias("broken"))
    g = s.groupBy(F.col("s_nationkey").alias("collection")).agg(F.count("*").alias("sites"), pulls.texts(F.collect_list(F.col("s_suppkey").cast("string"))).alias("ids"), pulls.texts(F.collect_list("s_name")).alias("names"))
    return g.join(broken, "collection", "left").select("collection", "sites", "ids", "names", F.col("broken").isNull().alias("complete"))


@query("""WITH e AS (SELECT o_orderkey AS k, o_custkey % 20 AS site FROM orders), l AS (SELECT DISTINCT l_orderkey AS k FROM lineitem), q AS (SELECT k, arg_max(status, run) AS status FROM (SELECT o_orderkey AS k, 1 AS run, 'quarantined' AS status FROM orders WHERE o_orderkey % 3 = 0 UNION ALL SELECT o_orderkey, 2, 'ok' FROM orders WHERE o_orderkey % 6 = 0) GROUP BY 1),
 x AS (SELECT site, l.k IS NULL AS absent, coalesce(status, '') = 'quarantined' AS quarantined FROM e LEFT JOIN l USING (k) LEFT JOIN q USING (k)), g AS (SELECT site, count(*) AS expected, count(*) FILTER (absent AND NOT quarantined) AS missing, count(*) FILTER (quarantined) AS quarantined FROM x GROUP BY 1)
 SELECT *, CASE site % 4 WHEN 0 THEN 'skip' WHEN 1 THEN 'copy' ELSE 'verify' END AS action, CASE WHEN site % 4 = 0 THEN 'not-asked' WHEN missing = 0 THEN 'ok' WHEN missing * 100 > expected THEN 'breach' ELSE 'incomplete' END AS verdict FROM g""")
def mapped_site_verdict(spark, sf_dir):
    """sites' manifests, a fresh listing, the last result of each item and the mapping's action; quarantined items aren't missing."""
    o = t(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    e = o.select(k.alias("k"), (F.col("o_custkey") % 20).alias("site"))
    listed = t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.lit(True).alias("there")).distinct()
    results = o.where(k % 3 == 0).select(k.alias("k"), F.lit(1).alias("run"), F.lit("quarantined").alias("status")).union(o.where(k % 6 == 0).select(k, F.lit(2), F.lit("ok")))
    last = results.groupBy("k").agg(F.max_by("status", "run").alias("status"))
    held = F.coalesce(F.col("status") == "quarantined", F.lit(False))
    g = e.join(listed, "k", "left").join(last, "k", "left").groupBy("site").agg(F.count("*").alias("expected"), F.count_if(F.col("there").isNull() & ~held).alias("missing"), F.count_if(held).alias("quarantined"))
    action = F.when(F.col("site") % 4 == 0, "skip").when(F.col("site") % 4 == 1, "copy").otherwise("verify")
    return g.withColumn("action", action).withColumn("verdict", D.decide("incomplete", (F.col("action") == "skip", "not-asked"), (F.col("missing") == 0, "ok"), (D.gate_breach(F.col("missing"), F.col("expected")), "breach")))


@query("""SELECT l_orderkey AS id, array_to_string(list_sort(list_distinct(list(CASE l_linenumber WHEN 1 THEN 'metadata.json' WHEN 2 THEN 'texttracks/en.vtt' ELSE CAST(l_linenumber AS VARCHAR) || '.mp4' END))), ',') AS tails,
 coalesce(array_to_string(list_sort(list_distinct(list(CAST(l_linenumber AS VARCHAR) || '.mp4') FILTER (l_linenumber > 2))), ','), '') AS media FROM lineitem GROUP BY 1""")
def video_tails(spark, sf_dir):
    """The path tails of each video, and those that are media."""
    n = F.col("l_linenumber")
    tail = F.when(n == 1, "metadata.json").when(n == 2, "texttracks/en.vtt").otherwise(F.concat(n.cast("string"), F.lit(".mp4")))
    names = t(spark, sf_dir, "lineitem").select(F.concat_ws("/", F.lit("videos"), F.col("l_orderkey").cast("string"), tail).alias("name"))
    parts = F.split("name", "/", 3)
    g = names.groupBy(parts[1].cast("long").alias("id")).agg(F.array_sort(F.collect_set(parts[2])).alias("t"))
    return g.select("id", F.array_join("t", ",").alias("tails"), F.array_join(F.filter("t", lambda x: (x != "metadata.json") & ~F.startswith(x, F.lit("texttracks/"))), ",").alias("media"))


def _results(spark, sf_dir):
    k = F.col("p_partkey")
    return t(spark, sf_dir, "part").select(
        F.col("p_brand").alias("kind"),
        F.concat(F.lit("u"), k.cast("string")).alias("unit"),
        pick(k, "ok", "failed", "skipped", "partial", "skipped-complete").alias("status"),
        pick(k, "", "", "no-access", "", "").alias("reason"),
        F.col("p_size").cast("long").alias("bytes"),
        (k % 7).alias("fill_errors"),
        (k % 9).alias("nulls"),
        (k % 6 == 0).alias("decomposed"),
        (k % 4).alias("hosted_errors"),
        (k % 3).alias("external"),
    )


_RESULTS = "r AS (SELECT p_brand AS kind, 'u' || CAST(p_partkey AS VARCHAR) AS unit, ['ok','failed','skipped','partial','skipped-complete'][p_partkey % 5 + 1] AS status, CAST(p_size AS BIGINT) AS bytes, p_partkey AS k FROM part)"
_MANIFEST = "kind, count(*) AS units, coalesce(string_agg(unit, ',' ORDER BY unit) FILTER (status = 'failed'), '') AS failed, coalesce(string_agg(unit, ',' ORDER BY unit) FILTER (status = 'partial'), '') AS partial, coalesce(string_agg(unit || ':no-access', ',' ORDER BY unit || ':no-access') FILTER (status = 'skipped'), '') AS skipped, CAST(coalesce(sum(bytes) FILTER (status IN ('ok', 'partial', 'skipped-complete')), 0) AS BIGINT) AS staged"


@query(f"WITH {_RESULTS} SELECT {_MANIFEST} FROM r GROUP BY kind")
def product_manifest(spark, sf_dir):
    """failed, skipped and partial units of a run, and staged bytes."""
    return pulls.run_manifest(_results(spark, sf_dir), "kind")


@query(f"WITH {_RESULTS} SELECT {_MANIFEST}, count(*) FILTER (k % 6 = 0) AS decomposed, CAST(sum(k % 7) AS BIGINT) AS fill_errors, CAST(sum(k % 9) AS BIGINT) AS render_nulls FROM r GROUP BY kind")
def design_manifest(spark, sf_dir):
    """the same with decomposed documents, fill errors and null renders."""
    return pulls.run_manifest(_results(spark, sf_dir), "kind", F.count_if("decomposed").alias("decomposed"), F.sum("fill_errors").alias("fill_errors"), F.sum("nulls").alias("render_nulls"))


@query(f"WITH {_RESULTS} SELECT {_MANIFEST}, CAST(sum(k % 4) AS BIGINT) AS hosted_errors FROM r GROUP BY kind")
def channel_manifest(spark, sf_dir):
    """the same with errors of hosted files."""
    return pulls.run_manifest(_results(spark, sf_dir), "kind", F.sum("hosted_errors").alias("hosted_errors"))


@query("""SELECT o_custkey AS repo, bool_or(o_orderstatus = 'P') AS failed, coalesce(array_to_string(list_sort(list(DISTINCT ['clone','wiki','json','lfs'][o_orderkey % 4 + 1]) FILTER (o_orderstatus = 'P')), ','), '') AS legs, CAST(sum(o_orderkey % 100) AS BIGINT) AS bytes FROM orders GROUP BY 1""")
def repository_manifest(spark, sf_dir):
    """repositories with any failed leg, the failed legs, and all bytes."""
    k = F.col("o_orderkey")
    return pulls.failed_units(t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("repo"), pick(k, "clone", "wiki", "json", "lfs").alias("leg"), F.when(F.col("o_orderstatus") == "P", "failed").otherwise("ok").alias("status"), (k % 100).alias("bytes")), "repo")


@query(f"WITH {_RESULTS} SELECT count(*) AS units, CAST(sum(bytes) AS BIGINT) AS bytes, count(*) FILTER (status IN ('failed', 'partial')) AS incomplete, CAST(sum(k % 3) AS BIGINT) AS external FROM r")
def export_manifest(spark, sf_dir):
    """totals, incomplete units and external files of an export's copy."""
    return _results(spark, sf_dir).agg(F.count("*").alias("units"), F.sum("bytes").alias("bytes"), F.count_if(F.col("status").isin("failed", "partial")).alias("incomplete"), F.sum("external").alias("external"))


@query("""WITH c AS (SELECT CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'skipped' ELSE 'failed' END AS outcome, o_orderkey % 100 AS bytes, CASE WHEN o_orderstatus = 'P' THEN ['403','404','timeout'][o_orderkey % 3 + 1] END AS error FROM orders)
 SELECT outcome AS name, count(*) AS n FROM c GROUP BY 1 UNION ALL SELECT 'bytes', CAST(coalesce(sum(bytes) FILTER (outcome = 'completed'), 0) AS BIGINT) FROM c UNION ALL SELECT 'error:' || error, count(*) FROM c WHERE error IS NOT NULL GROUP BY 1""")
def copy_counters(spark, sf_dir):
    """copies by outcome, copied bytes, failures by error."""
    s, k = F.col("o_orderstatus"), F.col("o_orderkey")
    return pulls.counters(t(spark, sf_dir, "orders").select(F.when(s == "F", "completed").when(s == "O", "skipped").otherwise("failed").alias("outcome"), (k % 100).alias("bytes"), F.when(s == "P", pick(k, "403", "404", "timeout")).alias("error")))


@query("""SELECT n_nationkey AS fleet, string_agg(o, ',' ORDER BY o) AS outcomes, CASE WHEN bool_or(o LIKE 'failed=%') THEN 1 ELSE 0 END AS exit_code FROM (SELECT n_nationkey, CASE WHEN c_custkey % 50 = 0 THEN 'failed' WHEN c_custkey % 2 = 0 THEN 'sized' ELSE 'skipped' END || '=' || CAST(count(*) AS VARCHAR) AS o FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, CASE WHEN c_custkey % 50 = 0 THEN 'failed' WHEN c_custkey % 2 = 0 THEN 'sized' ELSE 'skipped' END) GROUP BY 1""")
def fleet_exit(spark, sf_dir):
    """Outcomes of a fleet's entities; any failure makes the exit code 1."""
    k = F.col("c_custkey")
    state = F.when(k % 50 == 0, "failed").when(k % 2 == 0, "sized").otherwise("skipped")
    g = t(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("fleet"), state.alias("state")).agg(F.count("*").alias("n"))
    return g.groupBy("fleet").agg(pulls.texts(F.collect_list(F.concat_ws("=", "state", F.col("n").cast("string")))).alias("outcomes"), F.when(F.bool_or(F.col("state") == "failed"), 1).otherwise(0).alias("exit_code"))


@query("""WITH o AS (SELECT o_orderkey AS k, o_orderkey % 3 AS old, (o_orderkey + CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END) % 3 AS new, o_orderkey % 100 AS bytes FROM orders) SELECT ['copy','skip','review'][new + 1] AS action, count(*) AS n, CAST(sum(bytes) AS BIGINT) AS snapshot, count(*) FILTER (old <> new) AS changed FROM o GROUP BY 1""")
def plan_actions(spark, sf_dir):
    """a plan's actions with the snapshot's bytes, and the items whose action differs from the census'."""
    k = F.col("o_orderkey")
    o = t(spark, sf_dir, "orders")
    census = o.select(k, pick(k, "copy", "skip", "review").alias("before"))
    now = o.select(k, pick(k + F.when(k % 7 == 0, 1).otherwise(0), "copy", "skip", "review").alias("action"), (k % 100).alias("bytes"))
    return now.join(census, "o_orderkey").groupBy("action").agg(F.count("*").alias("n"), F.sum("bytes").alias("snapshot"), F.count_if(F.col("before") != F.col("action")).alias("changed"))


@query("""WITH j AS (SELECT CAST(floor(epoch(ts)) AS BIGINT) AS end_s, 60 AS seconds, event_id % 10 AS files FROM events), n AS (SELECT max(end_s) AS now FROM j), r AS (SELECT CAST(sum(files) AS BIGINT) AS files, CAST(max(now) - min(end_s - seconds) AS BIGINT) AS span, avg(seconds) AS mean FROM j, n WHERE end_s >= now - 86400) SELECT files, span, CAST(files AS DOUBLE) / span AS per_second, 5000 * mean / 16 / 3600 AS eta_hours FROM r""")
def throughput_eta(spark, sf_dir):
    """The trailing rate of jobs and the hours that pending ones take at its mean duration."""
    j = t(spark, sf_dir, "events").select(F.unix_timestamp(F.col("ts").cast("timestamp")).alias("end_s"), F.lit(60).alias("seconds"), (F.col("event_id") % 10).alias("files"))
    now = j.agg(F.max("end_s").alias("now"))
    return timeseries.trailing_rate(j.join(F.broadcast(now)), F.col("now"), 1440, pending=F.lit(5000), workers=16)


# ---- H, I, J, M: orders, references, documents, jobs


@query("""SELECT o_custkey % 20 AS site, count(*) AS items, CAST(sum(o_orderkey % 100) AS BIGINT) AS bytes, count(*) FILTER (o_orderstatus = 'F') AS copied, count(*) FILTER (o_orderstatus = 'P') AS failed, arg_max(o_orderkey, (o_orderkey % 100) * 100000000 - o_orderkey) AS first_item FROM orders GROUP BY 1""")
def site_result_rows(spark, sf_dir):
    """A site's result row; its work goes by size, largest first."""
    k = F.col("o_orderkey")
    first = F.max_by(k, F.struct((k % 100).alias("size"), (-k).alias("k")))
    s = F.col("o_orderstatus")
    return t(spark, sf_dir, "orders").groupBy((F.col("o_custkey") % 20).alias("site")).agg(F.count("*").alias("items"), F.sum(k % 100).alias("bytes"), F.count_if(s == "F").alias("copied"), F.count_if(s == "P").alias("failed"), first.alias("first_item"))


@query("""SELECT DISTINCT CASE WHEN event_id % 3 = 0 THEN 'r' || CAST(event_id AS VARCHAR) ELSE CAST(user_id AS VARCHAR) END AS message, 'c' || CAST(event_id % 40 AS VARCHAR) AS content FROM events WHERE event_id % 5 <> 0""")
def hosted_references(spark, sf_dir):
    """Distinct (innermost message, content) references in the bodies of threads and replies, of the service's host only."""
    e = F.col("event_id")
    host = F.when(e % 5 == 0, "elsewhere.test").otherwise("graph.test")
    reply = F.when(e % 3 == 0, F.concat(F.lit("/replies/r"), e.cast("string"))).otherwise("")
    url = F.concat(F.lit("https://"), host, F.lit("/messages/m"), reply, F.lit("/hostedContents/c"), (e % 40).cast("string"), F.lit("/$value"))
    body = F.concat(F.lit("<img src=q"), url, F.lit("q> and again <img src=q"), url, F.lit("q>"))
    return pulls.references(t(spark, sf_dir, "events").select(F.col("user_id").alias("message"), body.alias("body")), "https://graph[.]test/messages/[a-z0-9]+(?:/replies/([a-z0-9]+))?/hostedContents/([a-z0-9]+)", 2, 1)


def _documents(spark, sf_dir):
    k = F.col("c_custkey")
    node = F.transform(F.sequence(F.lit(1), (k % 120 + 1).cast("int")), lambda i: F.struct(F.concat(F.lit("p"), i.cast("string")).alias("id"), F.when(i % 4 == 0, "FRAME").otherwise("CANVAS").alias("type")))
    body = F.to_json(F.struct(node.alias("children")))
    return t(spark, sf_dir, "customer").select(k.alias("file"), F.from_json(body, "children array<struct<id:string,type:string>>").alias("doc"), (k % 120).alias("size"))


_NODES = "n AS (SELECT file, size, i, row_number() OVER (PARTITION BY file ORDER BY i) - 1 AS nth FROM (SELECT c_custkey AS file, c_custkey % 120 AS size, unnest(range(1, c_custkey % 120 + 2)) AS i FROM customer) WHERE i % 4 <> 0)"


@query(f"WITH {_NODES} SELECT file, 'p' || CAST(i AS VARCHAR) AS node, CASE WHEN size > 60 THEN nth // 50 END AS batch, size > 60 AS decomposed FROM n")
def document_nodes(spark, sf_dir):
    """A document's pages; oversized documents are decomposed in batches of 50."""
    return pulls.nodes(_documents(spark, sf_dir), "file", "doc", "size", 60)


@query(f"WITH {_NODES}, s AS (SELECT file, 'p' || CAST(i AS VARCHAR) AS node, CASE WHEN i % 5 = 0 THEN 'present' WHEN i % 7 <> 0 THEN 'rendered' WHEN i % 2 = 0 THEN 'rendered_again' ELSE 'null' END AS state FROM n) SELECT file, count(*) FILTER (state = 'present') AS present, count(*) FILTER (state = 'rendered') AS rendered, count(*) FILTER (state = 'rendered_again') AS rendered_again, count(*) FILTER (state = 'null') AS \"null\", coalesce(array_to_string(list_slice(list_sort(list(node) FILTER (state = 'null')), 1, 50), ','), '') AS nulls FROM s GROUP BY 1")
def render_states(spark, sf_dir):
    """Pages without an image are asked for, null ones once more; what stays null is recorded, the first 50 by name."""
    pages = pulls.nodes(_documents(spark, sf_dir), "file", "doc", "size", 60).select("file", "node")
    i = F.substring("node", 2, 10).cast("int")
    first = pages.where(i % 5 != 0).withColumn("url", F.when(i % 7 != 0, "https://i"))
    second = first.where("url is null").withColumn("url", F.when(i % 2 == 0, "https://j"))
    return pulls.renders(pages, pages.where(i % 5 == 0), first, second, "file")


@query("""SELECT o_custkey AS file, count(*) AS versions, least(count(*), 10) AS kept, array_to_string(list_slice(list(CAST(o_orderkey AS VARCHAR) ORDER BY o_orderkey DESC), 1, 10), ',') AS ids FROM orders GROUP BY 1""")
def version_lists(spark, sf_dir):
    """Versions put together over pages, newest first; the list is asked for up to ten."""
    pages = t(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("file"), (F.col("o_orderkey") % 3).alias("page")).agg(F.collect_list("o_orderkey").alias("ids"))
    ids = F.sort_array(F.flatten(F.collect_list("ids")), False)
    g = pages.groupBy("file").agg(ids.alias("all"))
    return g.select("file", F.size("all").cast("long").alias("versions"), F.least(F.size("all"), F.lit(10)).cast("long").alias("kept"), F.array_join(F.transform(F.slice("all", 1, 10), lambda x: x.cast("string")), ",").alias("ids"))


@query("""SELECT o_custkey AS file, count(*) AS branches, string_agg('b' || CAST(o_orderkey AS VARCHAR) || '=' || CASE o_orderstatus WHEN 'F' THEN 'ok' WHEN 'O' THEN 'skipped' ELSE 'failed' END, ',' ORDER BY 'b' || CAST(o_orderkey AS VARCHAR) || '=' || CASE o_orderstatus WHEN 'F' THEN 'ok' WHEN 'O' THEN 'skipped' ELSE 'failed' END) AS statuses FROM orders GROUP BY 1""")
def branch_statuses(spark, sf_dir):
    """The status of each branch of a document."""
    s = F.col("o_orderstatus")
    status = F.when(s == "F", "ok").when(s == "O", "skipped").otherwise("failed")
    return t(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("file")).agg(F.count("*").alias("branches"), pulls.texts(F.collect_list(F.concat(F.lit("b"), F.col("o_orderkey").cast("string"), F.lit("="), status))).alias("statuses"))


@query("""WITH l AS (SELECT l_orderkey AS k, max(l_linenumber) AS n FROM lineitem GROUP BY 1) SELECT o_custkey AS file, count(*) AS listed, count(n) AS present, count(*) FILTER (n IS NULL AND o_orderkey % 4 <> 0) AS downloaded, count(*) FILTER (n IS NULL AND o_orderkey % 4 = 0) AS errors, min(o_orderkey) FILTER (n IS NULL) AS first_ref FROM orders LEFT JOIN l ON k = o_orderkey GROUP BY 1""")
def fill_counts(spark, sf_dir):
    """Image references of a document: listed, there before, downloaded, failed; in order."""
    l = t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.lit(True).alias("there")).distinct()
    absent, k = F.col("there").isNull(), F.col("o_orderkey")
    return t(spark, sf_dir, "orders").join(l, "o_orderkey", "left").groupBy(F.col("o_custkey").alias("file")).agg(F.count("*").alias("listed"), F.count("there").alias("present"), F.count_if(absent & (k % 4 != 0)).alias("downloaded"), F.count_if(absent & (k % 4 == 0)).alias("errors"), F.min(F.when(absent, k)).alias("first_ref"))


@query("""WITH k AS (SELECT CASE WHEN doc_id % 50 = 0 THEN 'root' || CAST(doc_id AS VARCHAR) ELSE lang || '/' || CASE WHEN doc_id % 9 = 0 THEN 'f' || CAST(doc_id AS VARCHAR) ELSE source || '/' || CAST(doc_id AS VARCHAR) END END AS k FROM documents), s AS (SELECT string_split(k, '/') AS s FROM k)
 SELECT CASE WHEN len(s) = 1 THEN '' WHEN len(s) = 2 THEN s[1] || '/' ELSE s[1] || '/' || s[2] || '/' END AS prefix, count(*) AS objects, CAST(2 AS BIGINT) AS depth, CASE WHEN len(s) < 3 THEN 'S' ELSE 'R' END AS type FROM s GROUP BY 1, 4""")
def plan_jobs_deep(spark, sf_dir):
    """M5: few prefixes, so jobs at depth two; what lies beside them at the root and in split parents gets shallow jobs."""
    k = F.col("doc_id")
    i = k.cast("string")
    key = F.when(k % 50 == 0, F.concat(F.lit("root"), i)).otherwise(F.concat_ws("/", "lang", F.when(k % 9 == 0, F.concat(F.lit("f"), i)).otherwise(F.concat_ws("/", "source", i))))
    return planning.job_plan(t(spark, sf_dir, "documents").select(key.alias("k")), "k", 10, 1000).select("prefix", "objects", F.col("depth").cast("long").alias("depth"), "type")


@query("""SELECT doc_id, n_chars > 50000 AS refused, CASE WHEN n_chars > 50000 THEN NULL ELSE n_chars END AS blocks FROM (SELECT doc_id, n_chars * 10 AS n_chars FROM documents WHERE n_chars > 0)""")
def refused_blocks(spark, sf_dir):
    """M8: sizes of more than 50,000 blocks are refused, by a row of their own."""
    b = planning.blocks(t(spark, sf_dir, "documents").where("n_chars > 0").select("doc_id", (F.col("n_chars") * 10).alias("size")), "size", 1)
    return b.groupBy("doc_id").agg(F.bool_or("refused").alias("refused"), F.nullif(F.count("block"), F.lit(0)).alias("blocks"))


# ---- N: notes and tables


_RUNS = "r AS (SELECT c_custkey AS k, CAST(1000 * (c_custkey % 50 + 1) AS BIGINT) AS comp, CAST(1000 * (c_custkey % 50 + 1) * (90 + c_custkey % 20) // 100 AS BIGINT) AS unc, CASE WHEN c_custkey % 2 = 0 THEN c_custkey % 3 END AS trusted, CASE WHEN c_custkey % 2 = 0 THEN c_custkey % 5 END AS unmeasurable, CASE WHEN c_custkey % 3 = 1 THEN c_custkey % 4 END AS gz_uncertain, c_custkey % 7 AS gz, c_custkey % 6 AS parquet, c_custkey % 11 // 9 AS bad_zips FROM customer)"


@query(f"""WITH {_RUNS} SELECT k, concat_ws(';', CASE WHEN unc * 1.0 / comp BETWEEN 0.9 AND 1.02 THEN 'store-mode' END, CASE WHEN k % 8 = 0 THEN 'timestamps:20260101T000000Z' END, CASE WHEN trusted = 0 AND unmeasurable = 0 THEN 'verified' END, CASE WHEN trusted > 0 OR unmeasurable > 0 THEN 'residual:' || CAST(trusted + unmeasurable AS VARCHAR) END,
 CASE WHEN trusted IS NULL AND gz_uncertain > 0 THEN 'gz-uncertain:' || CAST(gz_uncertain AS VARCHAR) END, CASE WHEN trusted IS NULL AND gz_uncertain IS NULL AND gz > 0 THEN 'gz-floor' END, CASE WHEN parquet > 0 THEN 'parquet:' || CAST(parquet AS VARCHAR) END, CASE WHEN bad_zips > 0 THEN 'bad-zips:' || CAST(bad_zips AS VARCHAR) END) AS notes FROM r""")
def lore_notes(spark, sf_dir):
    """The readings that a run's numbers call for, all rules in order."""
    k = F.col("c_custkey")
    comp = (1000 * (k % 50 + 1)).cast("long")
    prefixes = F.when(k % 8 == 0, F.array(F.lit("crm"), F.lit("20260101T000000Z"))).otherwise(F.array(F.lit("crm")))
    deep = k % 2 == 0
    r = t(spark, sf_dir, "customer").select(k.alias("k"), comp.alias("comp"), F.floor(comp * (90 + k % 20) / 100).alias("unc"), prefixes.alias("prefixes"), F.when(deep, k % 3).alias("trusted"), F.when(deep, k % 5).alias("unmeasurable"), F.when(k % 3 == 1, k % 4).alias("gz_uncertain"), (k % 7).alias("gz"), (k % 6).alias("parquet"), F.floor(k % 11 / 9).alias("bad_zips"))
    return pulls.lore(r).select("k", F.array_join("notes", ";").alias("notes"))


@query("""SELECT n_name, CASE WHEN n_nationkey % 3 = 1 THEN n_name || ': ' || format('{:.1f}', n_nationkey * 1.5) || ' TB of ' || format('{:.2f}', n_nationkey * 1.25) || ' TB as stored. ' || CASE WHEN n_nationkey % 2 = 0 THEN 'by page' ELSE '' END END AS note FROM nation""")
def unit_notes(spark, sf_dir):
    """On what a unit-adjusted percentage rests."""
    k = F.col("n_nationkey")
    return t(spark, sf_dir, "nation").select("n_name", pulls.unit_note(F.col("n_name"), F.when(k % 3 == 1, k * 1.5e12), k * 1.25e12, F.when(k % 2 == 0, "by page")).alias("note"))


@query("""WITH s AS (SELECT s_nationkey AS slug, s_name AS source, CAST(100 + s_suppkey AS BIGINT) AS unc, CAST(CASE s_suppkey % 3 WHEN 0 THEN 100 + s_suppkey WHEN 1 THEN s_suppkey ELSE 0 END AS BIGINT) AS redundant FROM supplier), w AS (SELECT * FROM s WHERE redundant > 0)
 SELECT slug, CAST(sum(redundant) AS BIGINT) AS bytes, count(*) FILTER (redundant >= unc) AS whole, coalesce(array_to_string(list_slice(list_sort(list(source) FILTER (redundant >= unc)), 1, 3), ','), '') || CASE WHEN count(*) FILTER (redundant >= unc) > 3 THEN ',...' ELSE '' END AS whole_names, coalesce(array_to_string(list_sort(list(source || '=' || CAST(redundant AS VARCHAR)) FILTER (redundant < unc)), ','), '') AS parts FROM w GROUP BY 1""")
def duplicate_prefix_notes(spark, sf_dir):
    """Wholly and partly redundant prefixes of each entity."""
    k = F.col("s_suppkey")
    s = t(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("slug"), F.col("s_name").alias("source"), (100 + k).cast("long").alias("unc"), F.when(k % 3 == 0, 100 + k).when(k % 3 == 1, k).otherwise(0).cast("long").alias("redundant"))
    return pulls.duplicate_notes(s, "slug")


@query("""SELECT s_nationkey AS slug, CAST(sum(s_suppkey) AS BIGINT) AS bytes, string_agg(s_name || '(' || CAST(s_suppkey AS VARCHAR) || '):' || CASE WHEN s_suppkey % 2 = 0 THEN 'backup' ELSE 'logs' END, '; ' ORDER BY s_name || '(' || CAST(s_suppkey AS VARCHAR) || '):' || CASE WHEN s_suppkey % 2 = 0 THEN 'backup' ELSE 'logs' END) AS note FROM supplier WHERE s_suppkey % 4 <> 0 GROUP BY 1""")
def excluded_prefix_notes(spark, sf_dir):
    """Excluded prefixes of each entity with reasons."""
    k = F.col("s_suppkey")
    e = t(spark, sf_dir, "supplier").where(k % 4 != 0).select(F.col("s_nationkey").alias("slug"), F.col("s_name").alias("prefix"), k.alias("bytes"), F.when(k % 2 == 0, "backup").otherwise("logs").alias("reason"))
    return pulls.excluded_notes(e, "slug")


@query("""SELECT n_name, CASE WHEN n_nationkey % 4 = 0 AND n_nationkey > 0 THEN 'embedded' WHEN n_nationkey % 3 = 1 THEN 'equivalent' ELSE 'plain' END AS shown FROM nation""")
def service_table(spark, sf_dir):
    """How a service's size is shown: embedded or re-expressed ones are marked."""
    k = F.col("n_nationkey")
    shown = pulls.display(F.when(k % 4 == 0, 0).otherwise(k * 1000), k * 500, F.when(k % 3 == 1, k * 700))
    return t(spark, sf_dir, "nation").select("n_name", F.when(F.endswith(shown, F.lit("(embedded)")), "embedded").when(F.endswith(shown, F.lit("(equivalent)")), "equivalent").otherwise("plain").alias("shown"))


@query("""WITH h AS (SELECT n_nationkey AS k, CAST(n_nationkey * 1000 AS BIGINT) AS unc, CASE WHEN n_nationkey % 3 = 0 THEN n_nationkey * 100 END AS dup, CASE WHEN n_nationkey % 4 = 0 THEN n_nationkey * 50 END AS exc FROM nation) SELECT k, unc - coalesce(dup, 0) - coalesce(exc, 0) AS shown, dup IS NOT NULL OR exc IS NOT NULL AS adjusted, greatest(10000 - (unc - coalesce(dup, 0) - coalesce(exc, 0)), 0) AS remaining FROM h""")
def headline_choice(spark, sf_dir):
    """The figures a report leads with: adjusted where something was deducted, raw otherwise."""
    k = F.col("n_nationkey")
    h = t(spark, sf_dir, "nation").select(k.cast("long").alias("k"), (k * 1000).cast("long").alias("unc"), F.when(k % 3 == 0, k * 100).cast("long").alias("dup"), F.when(k % 4 == 0, k * 50).cast("long").alias("exc"))
    x = reconcile.headline(F.col("unc"), F.col("dup"), F.col("exc"), F.lit(10000).cast("long"))
    return h.select("k", x["unc"].alias("shown"), (F.col("dup").isNotNull() | F.col("exc").isNotNull()).alias("adjusted"), x["remaining"].alias("remaining"))


# ---- O: fleets


@query("""SELECT c_custkey AS entity, CASE WHEN c_acctbal < 0 THEN 'error' WHEN c_custkey % 5 = 0 AND c_custkey % 2 = 0 THEN 'skipped-unchanged' ELSE 'launched' END AS outcome, CASE WHEN c_acctbal < 0 THEN 'balance' END AS error FROM customer""")
def fleet_launches(spark, sf_dir):
    """O2: a launch of each entity by itself: what fails is a row of its own, unchanged ones are skipped."""
    c, k = t(spark, sf_dir, "customer"), F.col("c_custkey")
    error = F.when(F.col("c_acctbal") < 0, "balance")
    metric = F.when(k % 2 == 0, k % 5)
    start = timeseries.skip_reason(metric, F.lit(0), F.lit(True))
    return c.select(k.alias("entity"), F.when(error.isNotNull(), "error").when(start == "skip", "skipped-unchanged").otherwise("launched").alias("outcome"), error.alias("error"))


@query("""SELECT o_custkey AS entity, max(o_orderkey) AS probe, CASE arg_max(o_orderstatus, o_orderkey) WHEN 'F' THEN 'done' WHEN 'O' THEN 'running' ELSE 'died' END AS state FROM orders GROUP BY 1""")
def entity_states(spark, sf_dir):
    """The state of each entity's last probe: its marker, its process, or neither."""
    s = F.max_by("o_orderstatus", "o_orderkey")
    return t(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("entity")).agg(F.max("o_orderkey").alias("probe"), F.when(s == "F", "done").when(s == "O", "running").otherwise("died").alias("state"))


@query("""WITH s AS (SELECT o_custkey AS slug, arg_max(o_orderstatus, o_orderkey) AS state, max(o_orderkey) AS "at", count(*) AS blobs FROM orders GROUP BY 1) SELECT slug, "at", CASE WHEN state = 'F' THEN blobs ELSE c_nationkey END AS blobs, state <> 'F' AS copied FROM s JOIN customer ON c_custkey = slug WHERE state IN ('F', 'O')""")
def harvested_runs(spark, sf_dir):
    """Terminal entities get a run row of their summary; skipped ones carry the last run's totals forward."""
    o = t(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("slug")).agg(F.max_by("o_orderstatus", "o_orderkey").alias("state"), F.max("o_orderkey").alias("at"), F.count("*").alias("blobs")).where("state in ('F', 'O')")
    last = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("slug"), F.col("c_nationkey").cast("long").alias("previous"))
    copied = F.col("state") != "F"
    return o.join(last, "slug").select("slug", "at", F.when(copied, F.col("previous")).otherwise(F.col("blobs")).alias("blobs"), copied.alias("copied"))


@query("""SELECT o_orderkey AS file, CASE WHEN doc = 'failed' THEN 'failed' WHEN fills = 'ok' AND renders = 'ok' THEN 'ok' ELSE 'partial' END AS status, doc || '/' || fills || '/' || renders AS parts FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'failed' ELSE 'ok' END AS doc, CASE WHEN o_orderkey % 3 = 0 THEN 'errors' ELSE 'ok' END AS fills, CASE WHEN o_orderkey % 5 = 0 THEN 'nulls' ELSE 'ok' END AS renders FROM orders)""")
def file_statuses(spark, sf_dir):
    """A unit with the statuses of its parts: failed without its document, partial where a part has errors."""
    k = F.col("o_orderkey")
    parts = F.struct(F.when(F.col("o_orderstatus") == "P", "failed").otherwise("ok").alias("doc"), F.when(k % 3 == 0, "errors").otherwise("ok").alias("fills"), F.when(k % 5 == 0, "nulls").otherwise("ok").alias("renders"))
    u = t(spark, sf_dir, "orders").select(k.alias("file"), parts.alias("p"))
    status = F.when(F.col("p.doc") == "failed", "failed").when((F.col("p.fills") == "ok") & (F.col("p.renders") == "ok"), "ok").otherwise("partial")
    return u.select("file", status.alias("status"), F.concat_ws("/", "p.doc", "p.fills", "p.renders").alias("parts"))


# ---- S: pulls and probes


@query("""SELECT n_nationkey AS team, n_nationkey % 5 <> 4 AS ok, CASE WHEN n_nationkey % 5 = 4 THEN 0 ELSE count(DISTINCT s_suppkey % 3) END AS folders, CASE WHEN n_nationkey % 5 = 4 THEN 0 ELSE count(s_suppkey) END AS files, FALSE AS fatal FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1""")
def team_relations(spark, sf_dir):
    """Reachable and unreachable teams with their folders and files; only no team at all is fatal."""
    reach = t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("team"), (F.col("n_nationkey") % 5 != 4).alias("ok"))
    f = t(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("team")).agg(F.count_distinct(F.col("s_suppkey") % 3).alias("folders"), F.count("*").alias("files"))
    fatal = reach.agg((~F.bool_or("ok")).alias("fatal"))
    return reach.join(f, "team", "left").join(F.broadcast(fatal)).select("team", "ok", *(F.when(F.col("ok"), F.coalesce(c, F.lit(0))).otherwise(0).cast("long").alias(c) for c in ("folders", "files")), "fatal")


@query("""WITH m AS (SELECT c_custkey AS id, ['true', 'True', 'false', NULL][c_custkey % 4 + 1] AS has, CASE WHEN c_custkey % 10 <> 0 THEN c_custkey % 7 END AS record, CASE WHEN c_custkey % 15 <> 0 THEN 'm' || CAST(c_custkey AS VARCHAR) END AS message FROM customer)
 SELECT record, message, 'a' || CAST(i AS VARCHAR) AS attachment, 'attachments/' || CAST(record AS VARCHAR) || '/' || message || '/a' || CAST(i AS VARCHAR) AS target FROM (SELECT *, unnest(range(0, id % 3 + 1)) AS i FROM m WHERE lower(has) = 'true' AND record IS NOT NULL AND message IS NOT NULL)""")
def email_attachments(spark, sf_dir):
    """Attachments of the messages that say they have some, whatever the case, and carry both ids."""
    k = F.col("c_custkey")
    names = F.transform(F.sequence(F.lit(0).cast("long"), k % 3), lambda i: F.concat(F.lit("a"), i.cast("string")))
    m = t(spark, sf_dir, "customer").select(pick(k, "true", "True", "false", None).alias("has"), F.when(k % 10 != 0, k % 7).alias("record"), F.when(k % 15 != 0, F.concat(F.lit("m"), k.cast("string"))).alias("message"), names.alias("names"))
    good = m.where(F.lower("has") == "true").where("record is not null and message is not null")
    return good.select("record", "message", F.explode("names").alias("attachment")).withColumn("target", F.concat_ws("/", F.lit("attachments"), F.col("record").cast("string"), "message", "attachment"))


@query("""WITH r AS (SELECT l_orderkey AS record, CASE WHEN l_linenumber % 6 <> 0 THEN l_linenumber END AS id, CASE WHEN l_returnflag = 'R' THEN 'Emails' ELSE 'Deals' END AS parent, l_suppkey % 2 = 0 AS there FROM lineitem) SELECT parent, count(*) FILTER (id IS NULL) AS dropped, count(*) FILTER (id IS NOT NULL AND parent = 'Emails') AS deferred, count(*) FILTER (id IS NOT NULL AND parent <> 'Emails' AND there) AS skipped, count(*) FILTER (id IS NOT NULL AND parent <> 'Emails' AND NOT there) AS downloaded FROM r GROUP BY 1""")
def attachment_rows(spark, sf_dir):
    """Rows without ids are dropped, those of mails deferred to their parent, existing targets skipped."""
    n = F.col("l_linenumber")
    r = t(spark, sf_dir, "lineitem").select(F.when(n % 6 != 0, n).alias("id"), F.when(F.col("l_returnflag") == "R", "Emails").otherwise("Deals").alias("parent"), (F.col("l_suppkey") % 2 == 0).alias("there"))
    state = F.when(F.col("id").isNull(), "dropped").when(F.col("parent") == "Emails", "deferred").when(F.col("there"), "skipped").otherwise("downloaded")
    return r.groupBy("parent").agg(*(F.count_if(state == s).alias(s) for s in ("dropped", "deferred", "skipped", "downloaded")))


@query("""WITH e AS (SELECT c_nationkey AS portal, ['courses','catalog','kb','articles'][c_custkey % 4 + 1] AS endpoint, [200, 401, 404, 200, 500][c_custkey % 5 + 1] AS status FROM customer) SELECT portal, endpoint, max(CASE WHEN status = 200 THEN 1 ELSE 0 END) = 1 AS reachable, array_to_string(list_sort(list(DISTINCT CAST(status AS VARCHAR))), ',') AS statuses FROM e GROUP BY 1, 2""")
def endpoint_matrix(spark, sf_dir):
    """Which candidate endpoints of each portal can be reached, with all statuses seen."""
    k = F.col("c_custkey")
    e = t(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("portal"), pick(k, "courses", "catalog", "kb", "articles").alias("endpoint"), pick(k, 200, 401, 404, 200, 500).alias("status"))
    return e.groupBy("portal", "endpoint").agg(F.bool_or(F.col("status") == 200).alias("reachable"), pulls.texts(F.collect_set(F.col("status").cast("string"))).alias("statuses"))


def _lessons(spark, sf_dir):
    k = F.col("o_orderkey")
    return t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("course"), F.when(k % 8 != 0, k).alias("id"), F.when(k % 4 != 1, F.concat(F.lit("l"), k.cast("string"))).alias("url"))


@query("""SELECT c_custkey AS course, o_orderkey AS lesson, 'c' || CAST(c_custkey AS VARCHAR) || '/l' || CAST(o_orderkey AS VARCHAR) AS target FROM customer JOIN orders ON o_custkey = c_custkey WHERE o_orderkey % 8 <> 0 AND o_orderkey % 4 <> 1 AND c_custkey % 6 <> 0""")
def lesson_details(spark, sf_dir):
    """Lessons with an id and a URL, of courses with a URL."""
    courses = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("course"), F.when(F.col("c_custkey") % 6 != 0, F.concat(F.lit("c"), F.col("c_custkey").cast("string"))).alias("course_url"))
    j = _lessons(spark, sf_dir).where("id is not null and url is not null").join(courses.where("course_url is not null"), "course")
    return j.select("course", F.col("id").alias("lesson"), F.concat_ws("/", "course_url", "url").alias("target"))


@query("""SELECT c_custkey AS course, c_custkey % 9 <> 0 AS detail, CASE WHEN c_custkey % 9 <> 0 THEN coalesce(n, 0) ELSE 0 END AS lessons, CASE WHEN c_custkey % 9 = 0 THEN 'failed' WHEN n IS NULL THEN 'partial' ELSE 'ok' END AS status FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderkey % 8 <> 0 GROUP BY 1) ON o_custkey = c_custkey""")
def course_units(spark, sf_dir):
    """A catalogue's courses with their detail and lesson count."""
    n = _lessons(spark, sf_dir).where("id is not null").groupBy("course").agg(F.count("*").alias("n"))
    detail = F.col("course") % 9 != 0
    c = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("course")).join(n, "course", "left")
    return c.select("course", detail.alias("detail"), F.when(detail, F.coalesce("n", F.lit(0))).otherwise(0).alias("lessons"), D.decide("ok", (~detail, "failed"), (F.col("n").isNull(), "partial")).alias("status"))


@query("""WITH u AS (SELECT s_nationkey AS portal, s_name AS unit FROM supplier WHERE s_suppkey % 4 = 0) SELECT n_nationkey AS portal, coalesce(unit, 'kb') AS unit, CASE WHEN unit IS NULL THEN 'skipped' ELSE 'ok' END AS status FROM nation LEFT JOIN u ON portal = n_nationkey""")
def knowledge_units(spark, sf_dir):
    """A unit for each reachable collection of a portal, and one skipped row where there is none."""
    u = t(spark, sf_dir, "supplier").where("s_suppkey % 4 = 0").select(F.col("s_nationkey").alias("portal"), F.col("s_name").alias("unit"))
    return t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("portal")).join(u, "portal", "left").select("portal", F.coalesce("unit", F.lit("kb")).alias("unit"), F.when(F.col("unit").isNull(), "skipped").otherwise("ok").alias("status"))


@query("""SELECT 'team' AS kind, n_name AS name, CASE WHEN n_nationkey % 6 = 5 THEN 'unreachable' ELSE 'reachable' END AS status FROM nation UNION ALL SELECT 'folder', s_name, 'reachable' FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE n_nationkey % 6 <> 5""")
def drive_boundary(spark, sf_dir):
    """What lies inside the boundary: teams, and the folders of those that can be reached."""
    n = t(spark, sf_dir, "nation")
    teams = n.select(F.lit("team").alias("kind"), F.col("n_name").alias("name"), F.when(F.col("n_nationkey") % 6 == 5, "unreachable").otherwise("reachable").alias("status"))
    inside = n.where("n_nationkey % 6 <> 5").select(F.col("n_nationkey").alias("s_nationkey"))
    return teams.union(t(spark, sf_dir, "supplier").join(F.broadcast(inside), "s_nationkey", "left_semi").select(F.lit("folder"), "s_name", F.lit("reachable")))


@query("""WITH u AS (SELECT c_mktsegment AS module, ['settings','records','attachments','notes'][i] AS leg, i AS nth FROM (SELECT DISTINCT c_mktsegment FROM customer), (SELECT unnest([1, 2, 3, 4]) AS i)) SELECT module, leg, row_number() OVER (ORDER BY nth, module) AS place FROM u WHERE NOT (leg = 'notes' AND module = 'BUILDING')""")
def module_work_order(spark, sf_dir):
    """A run's units in order: all modules' settings first, then records, attachments and notes; modules without notes have no such unit."""
    modules = t(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("module")).distinct()
    u = modules.select("module", F.posexplode(F.array(*map(F.lit, ("settings", "records", "attachments", "notes")))).alias("at", "leg")).where("not (leg = 'notes' and module = 'BUILDING')")
    return planning.placed(u, "at", "module").select("module", "leg", "place")


@query("""WITH k AS (SELECT l_orderkey * 10 + l_linenumber AS k, CASE WHEN l_linenumber = 7 THEN 'd/' ELSE 'f' END AS shape, CASE WHEN l_linestatus = 'O' THEN 'STANDARD' ELSE 'GLACIER' END AS tier FROM lineitem), a AS (SELECT * FROM k ORDER BY k LIMIT 1000), b AS (SELECT * FROM k ORDER BY k LIMIT 20000)
 SELECT tier, count(*) AS n, tier = 'GLACIER' AS cold, (SELECT count(*) FILTER (shape = 'd/') FROM a) AS folders, (SELECT count(*) FILTER (shape <> 'd/') FROM a) AS files FROM b GROUP BY 1""")
def storage_probe(spark, sf_dir):
    """The shape of the first 1,000 keys and the storage classes of the first 20,000 (a probe's samples)."""
    k = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    rows = t(spark, sf_dir, "lineitem").select(k.alias("k"), (F.col("l_linenumber") == 7).alias("folder"), F.when(F.col("l_linestatus") == "O", "STANDARD").otherwise("GLACIER").alias("tier"))
    shape = rows.orderBy("k").limit(1000).agg(F.count_if("folder").alias("folders"), F.count_if(~F.col("folder")).alias("files"))
    tiers = rows.orderBy("k").limit(20000).groupBy("tier").agg(F.count("*").alias("n"))
    return tiers.join(F.broadcast(shape)).select("tier", "n", (F.col("tier") == "GLACIER").alias("cold"), "folders", "files")


@query("""SELECT o_custkey AS page, min(o_orderkey) AS sample, bool_or(o_orderkey % 2 = 0) AS html, bool_or(o_orderkey % 3 = 0) AS pdf, bool_or(o_orderkey % 2 = 0) OR bool_or(o_orderkey % 3 = 0) AS capable FROM orders GROUP BY 1""")
def row_capabilities(spark, sf_dir):
    """What a sample row can be asked for."""
    k = F.col("o_orderkey")
    html, pdf = F.bool_or(k % 2 == 0), F.bool_or(k % 3 == 0)
    return t(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("page")).agg(F.min(k).alias("sample"), html.alias("html"), pdf.alias("pdf"), (html | pdf).alias("capable"))


@query("""WITH s AS (SELECT CASE WHEN event_id % 2 = 0 THEN 'bearer' ELSE 'token' END AS auth, [200, 401, 403, 206, 410, 403, 200][event_id % 7 + 1] AS status FROM events), c AS (SELECT auth, CASE WHEN status IN (200, 206) THEN 'open' WHEN status = 401 THEN 'needs-auth' WHEN status = 403 THEN 'forbidden' ELSE 'gone' END AS kind, count(*) AS n FROM s GROUP BY 1, 2) SELECT auth, arg_max(kind, n * 10 + CASE kind WHEN 'open' THEN 4 WHEN 'needs-auth' THEN 3 WHEN 'gone' THEN 2 ELSE 1 END) AS verdict, CAST(sum(n) AS BIGINT) AS samples FROM c GROUP BY 1""")
def link_gate(spark, sf_dir):
    """A gate from sampled links' statuses, for each way to authorise."""
    e = F.col("event_id")
    return pulls.link_gate(t(spark, sf_dir, "events").select(F.when(e % 2 == 0, "bearer").otherwise("token").alias("auth"), pick(e, 200, 401, 403, 206, 410, 403, 200).alias("status")))


@query("""WITH c AS (SELECT lang, count(*) AS objects, CAST(sum(n_chars) AS BIGINT) AS bytes, count(*) FILTER (doc_id % 5 <> 0) AS open FROM documents GROUP BY 1) SELECT lang, objects, bytes, CAST(objects AS DOUBLE) / least(16.0 / 2.0, 6.0) / 3600 AS hours, CASE WHEN open * 2 > objects THEN 'open' ELSE 'closed' END AS gate FROM c""")
def export_probe(spark, sf_dir):
    """An export's census, how long its copy takes, and whether its links open."""
    c = t(spark, sf_dir, "documents").groupBy("lang").agg(F.count("*").alias("objects"), F.sum("n_chars").alias("bytes"), F.count_if(F.col("doc_id") % 5 != 0).alias("open"))
    return c.select("lang", "objects", "bytes", (planning.runtime_seconds(F.col("objects"), F.lit(2.0), 16, 6.0) / 3600).alias("hours"), F.when(F.col("open") * 2 > F.col("objects"), "open").otherwise("closed").alias("gate"))


@query("""WITH l AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_orderkey % 2 = 0), o AS (SELECT o_orderpriority AS folder, o_orderkey % 10 = 0 AS fallback, CASE WHEN o_orderkey % 11 = 0 THEN 'no-file' WHEN k IS NOT NULL THEN 'skipped-existing' WHEN o_orderkey % 7 = 0 THEN 'error' ELSE 'copied' END AS outcome, o_orderkey AS id FROM orders LEFT JOIN l ON k = o_orderkey) SELECT folder, outcome, count(*) AS n, count(*) FILTER (fallback) AS fallback_quality, min(id) AS first_id FROM o GROUP BY 1, 2""")
def video_outcomes(spark, sf_dir):
    """Each video's outcome by folder, with those copied in a fallback quality."""
    k = F.col("o_orderkey")
    there = t(spark, sf_dir, "lineitem").where("l_orderkey % 2 = 0").select(F.col("l_orderkey").alias("o_orderkey"), F.lit(True).alias("there")).distinct()
    state = pulls.outcome(k % 11 == 0, F.when(k % 7 == 0, "http"), F.coalesce("there", F.lit(False)))
    return t(spark, sf_dir, "orders").join(there, "o_orderkey", "left").groupBy(F.col("o_orderpriority").alias("folder"), state.alias("outcome")).agg(F.count("*").alias("n"), F.count_if(k % 10 == 0).alias("fallback_quality"), F.min(k).alias("first_id"))


@query("""WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_orderkey AS k FROM orders), f AS (SELECT DISTINCT month FROM m WHERE month(month) = 2) SELECT month, CASE WHEN k % 4 = 0 THEN 'placeholder' WHEN k % 9 = 0 THEN 'error' ELSE 'copied' END AS outcome, count(*) AS n FROM m WHERE month NOT IN (SELECT month FROM f) GROUP BY 1, 2 UNION ALL SELECT month, 'listing-failed', 1 FROM f""")
def monthly_outcomes(spark, sf_dir):
    """Recordings by month; a month that couldn't be listed fails alone; placeholders aren't copied."""
    k = F.col("o_orderkey")
    m = t(spark, sf_dir, "orders").select(F.trunc(F.col("o_orderdate"), "MM").alias("month"), k)
    failed = m.where(F.month("month") == 2).select("month").distinct()
    return pulls.isolated(m, "month", failed, F.when(k % 4 == 0, "placeholder").when(k % 9 == 0, "error").otherwise("copied"))


@query("""SELECT page_id % 20 AS page, count(*) AS copied, array_to_string(list_sort(list(DISTINCT split_part(url, '?', 1))), ',') AS assets FROM pages GROUP BY 1""")
def asset_manifests(spark, sf_dir):
    """The distinct assets of each page, without their queries."""
    p = t(spark, sf_dir, "pages").select((F.col("page_id") % 20).alias("page"), F.substring_index("url", "?", 1).alias("asset"))
    return p.groupBy("page").agg(F.count("*").alias("copied"), pulls.texts(F.collect_set("asset")).alias("assets"))


@query("""SELECT page_id, CASE WHEN html = '' THEN 'error' WHEN page_id % 3 = 0 THEN 'skipped-existing' ELSE 'copied' END AS html, CASE WHEN page_id % 5 = 0 THEN 'no-file' WHEN page_id % 7 = 0 THEN 'error' ELSE 'copied' END AS pdf FROM pages""")
def page_outcomes(spark, sf_dir):
    """The outcomes of a page's two forms."""
    k = F.col("page_id")
    html = pulls.outcome(F.lit(False), F.when(F.col("html") == "", "empty"), (k % 3 == 0) & (F.col("html") != ""))
    return t(spark, sf_dir, "pages").select("page_id", html.alias("html"), pulls.outcome(k % 5 == 0, F.when(k % 7 == 0, "http"), F.lit(False)).alias("pdf"))


@query("""WITH o AS (SELECT o_orderpriority AS prefix, CASE WHEN o_orderkey % 3 = 0 THEN 'a/' ELSE '' END AS sub, o_orderkey % 9 AS size, o_orderkey AS k FROM orders), x AS (SELECT * FROM o WHERE prefix <> '1-URGENT' AND NOT (prefix = '5-LOW' AND k % 2 = 0) AND NOT (prefix = '3-MEDIUM' AND sub = 'a/')), j AS (SELECT DISTINCT prefix, starts_with(prefix, '3') AS shallow FROM o),
 s AS (SELECT prefix, count(*) FILTER (NOT shallow OR sub = '') AS n, CAST(coalesce(sum(size) FILTER (NOT shallow OR sub = ''), 0) AS BIGINT) AS b FROM o JOIN j USING (prefix) GROUP BY 1), d AS (SELECT prefix, count(*) FILTER (NOT shallow OR sub = '') AS n, CAST(coalesce(sum(CASE WHEN prefix = '2-HIGH' THEN 8 - size ELSE size END) FILTER (NOT shallow OR sub = ''), 0) AS BIGINT) AS b, bool_or(prefix = '2-HIGH') AS deep FROM x JOIN j USING (prefix) GROUP BY 1)
 SELECT j.prefix, CASE WHEN shallow THEN 'S' ELSE 'R' END AS type, s.n AS src_n, d.n AS dst_n, CASE WHEN d.n IS NULL THEN 'LIST-ERROR' WHEN s.n = d.n AND s.b = d.b THEN 'ok' WHEN s.n = d.n THEN 'DEEP-DIFF' ELSE 'MISMATCH' END AS status FROM j JOIN s USING (prefix) LEFT JOIN d USING (prefix)""")
def job_states(spark, sf_dir):
    """Each job's ends: ok, MISMATCH, LIST-ERROR, or DEEP-DIFF where counts agree and bytes don't; shallow jobs count their own level only."""
    k = F.col("o_orderkey")
    o = t(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("prefix"), F.when(k % 3 == 0, "a/").otherwise("").alias("sub"), (k % 9).alias("size"), k)
    d = o.where("prefix <> '1-URGENT' and not (prefix = '5-LOW' and o_orderkey % 2 = 0) and not (prefix = '3-MEDIUM' and sub = 'a/')").withColumn("size", F.when(F.col("prefix") == "2-HIGH", 8 - F.col("size")).otherwise(F.col("size")))
    jobs = o.select("prefix", F.startswith("prefix", F.lit("3")).alias("shallow")).distinct()
    level = [x.join(jobs, "prefix").where("not shallow or sub = ''") for x in (o, d)]
    r = O.rolled_up(jobs, *level, "prefix", deep=True)
    return r.select("prefix", F.when(F.col("shallow"), "S").otherwise("R").alias("type"), "src_n", "dst_n", "status")


@query("""SELECT n_nationkey AS vm, CASE WHEN n_nationkey % 4 = 1 THEN 'refused:other-scope' WHEN n_nationkey % 4 = 3 THEN 'refused:running' END AS refusal FROM nation""")
def scope_guard(spark, sf_dir):
    """A machine that runs another scope, or runs already, refuses a launch."""
    k = F.col("n_nationkey")
    running, scope = F.when(k % 2 == 1, True).otherwise(False), F.when(k % 4 == 1, "other").otherwise("mine")
    return t(spark, sf_dir, "nation").select(k.alias("vm"), F.when(running & (scope != "mine"), "refused:other-scope").when(running, "refused:running").alias("refusal"))


@query("""WITH e AS (SELECT o_orderkey AS k, o_orderpriority AS lib FROM orders), l AS (SELECT * FROM e WHERE k IN (SELECT l_orderkey FROM lineitem)), m AS (SELECT * FROM e WHERE k NOT IN (SELECT l_orderkey FROM lineitem) ORDER BY k LIMIT 20), n AS (SELECT m.lib, m.k, l.k AS neighbour, row_number() OVER (PARTITION BY m.k ORDER BY l.k) AS rn FROM m LEFT JOIN l USING (lib)) SELECT lib, k, neighbour FROM n WHERE rn <= 2""")
def gate_neighbours(spark, sf_dir):
    """The first 20 missing items with the first two landed neighbours of their library (a report)."""
    e = t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderpriority").alias("lib"))
    l = e.join(t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k")).distinct(), "k", "left_semi")
    return O.gate_neighbours(e, l, "lib", "k")


# ---- A, K: archives by ranges


def _zip64(z: bytes, locator: int | None, count_only: bool = False) -> bytes:
    """A zip archive whose end record is saturated, with a 64-bit record behind the directory unless only the count is."""
    import struct

    at = z.rfind(b"PK\x05\x06")
    entries, size, offset = struct.unpack("<HII", z[at + 10 : at + 20])
    if count_only:
        return z[: at + 8] + b"\xff" * 4 + z[at + 12 :]
    record = b"PK\x06\x06" + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, entries, entries, size, offset)
    found = b"PK\x06\x07" + struct.pack("<IQI", 0, at if locator is None else locator, 1)
    return z[:at] + record + found + z[at : at + 8] + b"\xff" * 12 + z[at + 20 :]


def _archives(spark, sf_dir):
    """Archives of all kinds, made of part: two entries of p_size * 10 and k % 100 bytes, whole, 64-bit, damaged and otherwise packed."""

    def make(batches):
        import bz2
        import gzip
        import io
        import lzma
        import zipfile

        import pandas as pd

        for df in batches:
            rows = []
            for k, n in zip(df["p_partkey"].tolist(), df["p_size"].tolist(), strict=True):
                one, two = b"x" * (n * 10), b"y" * (k % 100)
                kind = k % 10
                if kind >= 7:
                    end, pack = (("bz2", bz2.compress), ("xz", lzma.compress), ("gz", gzip.compress))[kind - 7]
                    rows.append((f"{k}.{end}", pack(one) + pack(two)))
                    continue
                with zipfile.ZipFile(held := io.BytesIO(), "w", zipfile.ZIP_DEFLATED) as z:
                    z.writestr("slack/day.json", one)
                    z.writestr("takeout/Drive/f.bin" if k % 3 else "other/f.bin", two)
                whole = held.getvalue()
                rows.append((f"{k}.zip", (whole, _zip64(whole, None), _zip64(whole, 1), _zip64(whole, None, True), whole[:-30], b"PK", b"PK\x05\x06" + b"\0" * 18)[kind]))
            yield pd.DataFrame(rows, columns=["path", "content"])

    return t(spark, sf_dir, "part").select("p_partkey", "p_size").mapInPandas(make, "path string, content binary")


@query("""SELECT p_partkey AS id, CASE WHEN p_partkey % 10 < 4 THEN 'zip:2entries' WHEN p_partkey % 10 = 4 THEN 'zip-no-eocd' WHEN p_partkey % 10 = 5 THEN 'zip-tiny' ELSE 'zip:0entries' END AS method, CASE WHEN p_partkey % 10 < 4 THEN CAST(p_size * 10 + p_partkey % 100 AS BIGINT) WHEN p_partkey % 10 = 5 THEN 2 WHEN p_partkey % 10 = 6 THEN 0 END AS size, p_partkey % 10 = 4 AS stored FROM part WHERE p_partkey % 10 < 7""")
def zip_directories(spark, sf_dir):
    """Sizes of zip archives from their ends alone: 64-bit records, a wrong locator, a saturated count, no end, no entries."""
    from ..operators import archives

    m = archives.members(_archives(spark, sf_dir).where("path like '%.zip'"))
    rows = m.groupBy("path", "clen", "uncomp", "method").agg(F.count("entry").alias("n"))
    stored = F.col("method") == "zip-no-eocd"
    return rows.select(F.substring_index("path", ".", 1).cast("long").alias("id"), "method", F.when(~stored, F.col("uncomp")).alias("size"), (stored & (F.col("uncomp") == F.col("clen"))).alias("stored"))


@query("""SELECT service, CAST(sum(n) AS BIGINT) AS bytes, count(*) AS archives FROM (SELECT 'slack' AS service, p_size * 10 AS n FROM part WHERE p_partkey % 10 < 4 UNION ALL SELECT 'gdrive', p_partkey % 100 FROM part WHERE p_partkey % 10 < 4 AND p_partkey % 3 <> 0) GROUP BY 1""")
def entry_services(spark, sf_dir):
    """F2, K2: services detected by the paths of archives' entries, with their bytes."""
    from ..operators import archives

    rows = archives.attributed(archives.members(_archives(spark, sf_dir).where("path like '%.zip'")), S.matcher())
    e = rows.select(F.explode("entries").alias("service", "bytes"))
    return e.groupBy("service").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("archives"))


@query("""SELECT p_partkey AS id, ['bz2-exact', 'xz-exact', 'gz-exact'][p_partkey % 10 - 6] AS method, CAST(p_size * 10 + p_partkey % 100 AS BIGINT) AS uncomp FROM part WHERE p_partkey % 10 >= 7""")
def streamed_archives(spark, sf_dir):
    """Archives of several members read through, a bounded chunk at a time."""
    from ..operators import binary

    s = binary.sized(_archives(spark, sf_dir).where("path not like '%.zip'"), deep=True)
    return s.select(F.substring_index("path", ".", 1).cast("long").alias("id"), "method", "uncomp")


@query("""SELECT p_partkey AS id, CASE WHEN p_partkey % 10 < 4 THEN 'zip-exact' ELSE 'zip:0entries' END AS method, CASE WHEN p_partkey % 10 < 4 THEN CAST(p_size * 10 + p_partkey % 100 AS BIGINT) ELSE 0 END AS uncomp FROM part WHERE p_partkey % 10 IN (0, 1, 6)""")
def inflated_archives(spark, sf_dir):
    """Every entry of a zip archive inflated."""
    from ..operators import binary

    files = _archives(spark, sf_dir).where(F.substring_index("path", ".", 1).cast("long") % 10 % 5 < 2).where(F.substring_index("path", ".", 1).cast("long") % 10 != 5).where("path like '%.zip'")
    return binary.sized(files, deep=True).select(F.substring_index("path", ".", 1).cast("long").alias("id"), "method", "uncomp")


@query("""WITH o AS (SELECT o_custkey AS module, o_orderkey AS id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS up, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS down FROM orders), g AS (SELECT module, count(*) AS at_source, count(*) FILTER (up <= 6 OR down <= 6) AS kept, count(*) FILTER (up <= 6 AND down <= 6) AS seen_twice FROM o GROUP BY 1) SELECT module, at_source, kept, seen_twice, CASE WHEN kept >= at_source THEN 'complete' ELSE 'gap-in-the-middle' END AS state FROM g""")
def two_way_walks(spark, sf_dir):
    """An ascending and a descending walk, each capped at six rows by its source, put together by id and held against the source's count."""
    o = t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("module"), F.col("o_orderkey").alias("id"))
    six = [F.row_number().over(Window.partitionBy("module").orderBy(x)) <= 6 for x in ("id", F.desc("id"))]
    walks = [o.withColumn("seen", x).where("seen").drop("seen") for x in six]
    kept = R.two_way(*walks, "id", "id").groupBy("module").agg(F.count("*").alias("kept"), F.count_if(F.col("ways") == 3).alias("seen_twice"))
    j = o.groupBy("module").agg(F.count("*").alias("at_source")).join(kept, "module")
    return j.select("module", "at_source", "kept", "seen_twice", O.complete(F.col("kept"), F.col("at_source"), F.lit(True)).alias("state"))


@query("""SELECT CASE WHEN k % 4 = 1 THEN 'parquet-bad-magic' WHEN k % 4 = 3 THEN 'parquet-tiny' ELSE 'parquet-footer' END AS method, count(*) AS files, CASE WHEN k % 4 IN (0, 2) THEN TRUE ELSE FALSE END AS holds_values FROM (SELECT p_partkey AS k FROM part) GROUP BY 1, 3""")
def parquet_footers(spark, sf_dir):
    """K5, K6, K7, K8, K9: uncompressed sizes from Parquet footers; broken and tiny files count as stored."""
    from ..operators import binary

    def make(batches):
        import io

        import pandas as pd
        import pyarrow as pa
        import pyarrow.parquet as pq

        for df in batches:
            rows = []
            for k in df["p_partkey"].tolist():
                pq.write_table(pa.table({"v": list(range(200))}), held := io.BytesIO(), use_dictionary=False)
                body = held.getvalue()
                rows.append((f"{k}.parquet", (body, body[:-1], body, b"PAR1")[k % 4]))
            yield pd.DataFrame(rows, columns=["path", "content"])

    s = binary.sized(t(spark, sf_dir, "part").select("p_partkey").mapInPandas(make, "path string, content binary"))
    holds = (F.col("method") == "parquet-footer") & (F.col("uncomp") >= 1600)
    return s.groupBy("method", holds.alias("holds_values")).agg(F.count("*").alias("files")).select("method", "files", "holds_values")


@query("""SELECT DISTINCT 'c' || CAST(n_nationkey % 3 AS VARCHAR) AS conversation, CAST(count(*) OVER (PARTITION BY n_nationkey % 3) AS BIGINT) AS day_files, TRUE AS is_export FROM nation""")
def tree_export(spark, sf_dir):
    """An extracted export is read like an archive: its root's signature files and its conversations' day files."""
    from ..sources import writers as W

    k = F.col("n_nationkey")
    path = W.scratch(spark, "tree")
    days = t(spark, sf_dir, "nation").select(F.concat(F.lit("c"), (k % 3).cast("string")).alias("place"), F.concat_ws("", F.lit('{"day":'), k.cast("string"), F.lit("}")).alias("value"))
    days.repartition(25, "value").write.partitionBy("place").option("maxRecordsPerFile", 1).text(f"{path}/days")
    for name in ("channels", "users"):
        spark.range(1).select(F.lit("[]").alias("value")).coalesce(1).write.text(f"{path}/{name}.json")
    files = R.tree(spark, path).withColumn("rel", F.regexp_extract("path", r"/tree-[0-9a-f]+/(.*)$", 1))
    root = files.agg((F.bool_or(F.startswith("rel", F.lit("channels.json"))) & F.bool_or(F.startswith("rel", F.lit("users.json")))).alias("is_export"))
    day = files.where("startswith(rel, 'days/')").select(F.regexp_extract("rel", r"place=([^/]+)/", 1).alias("conversation"))
    return day.groupBy("conversation").agg(F.count("*").alias("day_files")).join(F.broadcast(root)).select("conversation", "day_files", "is_export")
