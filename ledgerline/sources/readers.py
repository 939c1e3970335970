"""Readers and writers of landed inventories, manifests, ledgers and archives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import EXTENSIONS, first_of

MANIFEST, LISTING, VERSIONS = "key string, size long", "name string, clen long, etag string", "key string, version string, size long, etag string, is_latest boolean, last_modified string"
CACHE = ["name", "etag", "clen", "uncomp", "method", "detected"]
LEDGER = "end_epoch long, type string, arg string, job_id string, completed string, failed string, skipped string, bytes string, seconds string"


def json_documents(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """One JSON document a file, with the file's name as order key; dot files are hidden from Spark's readers."""
    r = spark.read.option("multiLine", True)
    return (r.schema(schema) if schema else r).json(path).withColumn("file", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))


def json_lines(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """JSON lines; blank and broken ones are skipped."""
    r = spark.read.option("mode", "DROPMALFORMED")
    return (r.schema(schema) if schema else r).json(path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """key<TAB>size; an empty size is 0."""
    return spark.read.schema(MANIFEST).csv(path, sep="\t", quote="").withColumn("size", F.coalesce("size", F.lit(0)))


def listing_pages(spark: SparkSession, path: str) -> DataFrame:
    """XML list pages as (name, clen, etag); missing sizes are 0, missing etags empty."""
    schema = "Name string, Properties struct<`Content-Length`: long, Etag: string>"
    x = spark.read.format("xml").option("rowTag", "Blob").schema(schema).load(path)
    return x.select(F.col("Name").alias("name"), F.coalesce(F.col("Properties.`Content-Length`"), F.lit(0)).alias("clen"), F.coalesce("Properties.Etag", F.lit("")).alias("etag"))


def cache_index(spark: SparkSession, path: str, fingerprint: str) -> DataFrame:
    """A cache of measured blobs; empty where the fingerprint differs. Bad rows are misses; the last row of a name wins."""
    lines = spark.read.text(path).select("value", F.monotonically_increasing_id().alias("seq"))
    same = lines.where(F.col("value") == F.lit(f"#matcher {fingerprint}")).limit(1).select(F.lit(True).alias("same"))
    p = F.split("value", "\t")
    rows = lines.where(~F.startswith("value", F.lit("#")) & (F.size(p) >= 5)).select("seq", *(F.get(p, F.lit(i)).alias(c) for i, c in enumerate(CACHE)))
    rows = rows.withColumn("clen", F.col("clen").try_cast("long")).withColumn("uncomp", F.col("uncomp").try_cast("long"))
    ok = rows.where("etag <> '' and clen is not null and uncomp is not null and not startswith(method, 'err:')")
    last = ok.groupBy("name").agg(F.max_by(F.struct("etag", "clen", "uncomp", "method", "detected"), "seq").alias("r")).select("name", "r.*")
    return last.join(F.broadcast(same)).drop("same")


def seeded(cache: DataFrame, seed: DataFrame) -> DataFrame:
    """A crashed run's rows over a cache's."""
    return seed.unionByName(cache.join(seed.select("name"), "name", "left_anti"))


def write_cache(rows: DataFrame, path: str, fingerprint: str) -> None:
    rows.withColumn("fingerprint", F.lit(fingerprint)).write.mode("overwrite").parquet(path)


def copy_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Copy jobs; '?' and other non-numbers are unknown, not zero."""
    x = spark.read.schema(LEDGER).csv(path, sep="\t", quote="")
    return x.select("end_epoch", "type", "arg", "job_id", *(F.col(c).try_cast("long").alias(c) for c in ("completed", "failed", "skipped", "bytes", "seconds")))


def catalogue_csv(spark: SparkSession, path: str, key: str, required: list[str]) -> DataFrame:
    """A CSV with named columns and a unique key; the first broken promise is an error."""
    x = spark.read.csv(path, header=True, encoding="UTF-8", multiLine=True)
    x = x.toDF(*(c.lstrip("﻿") for c in x.columns))
    if missing := [c for c in required if c not in x.columns]:
        raise ValueError(f"columns are missing: {missing}")
    if twice := x.groupBy(key).count().where("count > 1").limit(1).collect():
        raise ValueError(f"{key} {twice[0][0]!r} appears more than once")
    return x


def archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path)


def day_files(files: DataFrame) -> DataFrame:
    """Names of the form <conversation>/<day>.json."""
    return files.where(F.rlike("name", F.lit("^[^/]+/[^/]+\\.json$")))


def first_per_id(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each id; rows without an id all stay."""
    named = F.coalesce(F.col(key).cast("string"), F.lit("")) != ""
    first = rows.where(named).groupBy(key).agg(F.min_by(F.struct(*rows.columns), order).alias("r")).select("r.*")
    return first.unionByName(rows.where(~named))


def patched(ledger: DataFrame, key: str, column: str, updates: DataFrame) -> DataFrame:
    """UPDATE ledger SET column = updates.column where the key is there."""
    u = updates.select(key, F.col(column).alias("_new"))
    return ledger.join(u, key, "left").withColumn(column, F.coalesce("_new", column)).drop("_new").select(ledger.columns)


def walked(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(expected, collisions) of walked items (rel, size, is_folder, deleted): a path with two sizes is nobody's."""
    files = pages.where(~F.coalesce("is_folder", F.lit(False)) & ~F.coalesce("deleted", F.lit(False)))
    g = files.groupBy("rel").agg(F.min("size").alias("size"), F.max("size").alias("largest"))
    return g.where(F.col("size").eqNullSafe(F.col("largest"))).select("rel", "size"), g.where(~F.col("size").eqNullSafe(F.col("largest"))).select("rel")


def manifest_rows(lines: DataFrame) -> DataFrame:
    """Manifest lines (rel, size, drive, item[, mime]); a line of four columns gets its type from the name's ending. Headers start with #."""
    p = F.split("value", "\t")
    kinds = F.create_map(*(F.lit(x) for kind, ext in EXTENSIONS.items() for x in (ext, kind)))
    guess = F.try_element_at(kinds, F.lower(F.regexp_extract(F.get(p, F.lit(0)), r"\.[A-Za-z0-9]+$", 0)))
    rows = lines.where(~F.startswith("value", F.lit("#")) & (F.size(p) >= 4))
    return rows.select(F.get(p, F.lit(0)).alias("rel"), F.coalesce(F.get(p, F.lit(1)).try_cast("long"), F.lit(0)).alias("size"), F.get(p, F.lit(2)).alias("drive"), F.get(p, F.lit(3)).alias("item"), F.coalesce(F.nullif(F.get(p, F.lit(4)), F.lit("")), guess, F.lit("application/octet-stream")).alias("mime"))


def page_rows(pages: DataFrame) -> DataFrame:
    """(name, clen, etag) of XML list pages held in a column."""
    schema = "Blobs struct<Blob: array<struct<Name: string, Properties: struct<`Content-Length`: bigint, Etag: string>>>>"
    b = pages.select(F.explode(F.from_xml("page", schema)["Blobs"]["Blob"]).alias("b"))
    return b.select(F.col("b.Name").alias("name"), F.coalesce(F.col("b.Properties.`Content-Length`"), F.lit(0)).alias("clen"), F.coalesce("b.Properties.Etag", F.lit("")).alias("etag"))


def rows_of_lines(lines: DataFrame, schema: str) -> DataFrame:
    """JSON lines held in a column; blank and broken ones go."""
    row = F.from_json("value", f"{schema}, _broken string", {"columnNameOfCorruptRecord": "_broken"})
    return lines.select(row.alias("r")).where("r is not null and r._broken is null").select("r.*").drop("_broken")


def first_per_row(rows: DataFrame, key: str, columns: list[str], order: str) -> DataFrame:
    """The first row of each id; rows without one are told apart by their canonical JSON."""
    mark = F.when(F.col(key).isNotNull(), F.concat(F.lit("#"), F.col(key).cast("string"))).otherwise(F.to_json(F.struct(*columns)))
    return rows.groupBy(mark.alias("_mark")).agg(F.min_by(F.struct(*rows.columns), order).alias("r")).select("r.*")


def enveloped(pages: DataFrame, body: str, keys: tuple[str, ...]) -> DataFrame:
    """Each page's items as JSON texts, from a bare array or the first envelope key that holds one, and the page's next cursor."""
    bare = F.when(F.startswith(F.ltrim(F.col(body)), F.lit("[")), F.col(body))
    cursor = first_of(*(F.get_json_object(body, p) for p in ("$.nextCursor", "$.cursor", "$.paging.next")))
    items = F.from_json(F.coalesce(bare, *(F.get_json_object(body, f"$.{k}") for k in keys)), "array<variant>")
    return pages.withColumn("cursor", cursor).withColumn("item", F.explode(F.transform(items, lambda x: F.to_json(x)))).drop(body)


def list_page(names: DataFrame, name: str, prefix: str, marker: str = "", delimiter: str | None = None, size: int = 5000) -> DataFrame:
    """One page (entry, is_prefix, n) of a listing: names under the prefix and behind the marker, those with the delimiter further on rolled up.

    The filters are plain comparisons of the name, so they reach a Parquet scan. A page's size is what listings are asked for.
    """
    under = names.where(F.startswith(F.col(name), F.lit(prefix)) & (F.col(name) > marker))
    entry = F.col(name)
    if delimiter:
        rest = F.substring(F.col(name), len(prefix) + 1, 1 << 20)
        entry = F.when(F.contains(rest, F.lit(delimiter)), F.concat(F.lit(prefix), F.substring_index(rest, delimiter, 1), F.lit(delimiter))).otherwise(entry)
    return under.groupBy(entry.alias("entry")).agg(F.count("*").alias("n")).withColumn("is_prefix", F.endswith("entry", F.lit(delimiter)) if delimiter else F.lit(False)).orderBy("entry").limit(size)


def relative(listing: DataFrame, prefix: str) -> DataFrame:
    """The listing's rows under a prefix, with the key relative to it."""
    return listing.where(F.startswith("name", F.lit(prefix))).withColumn("key", F.expr(f"substring(name, {len(prefix) + 1})")).where("key <> ''")


def by_folder(listing: DataFrame, prefix: str) -> DataFrame:
    """(folder, rel, size); rows without a folder or with an empty rest are left out."""
    rows = relative(listing, prefix).select(F.substring_index("key", "/", 1).alias("folder"), F.expr("substring(key, length(substring_index(key, '/', 1)) + 2)").alias("rel"), "size")
    return rows.where("folder <> '' and rel <> ''")


def token_ledger(entities: DataFrame, files: DataFrame, key: str) -> DataFrame:
    """Each entity's token records (id, expires) of its ledger's JSON; a missing or broken ledger has none. files: (key, body)."""
    schema = "struct<tokens:array<struct<id:string,expires:string>>>"
    got = files.select(key, F.from_json("body", schema).alias("ledger"))
    return entities.join(got, key, "left").select(key, F.explode_outer("ledger.tokens").alias("token")).select(key, "token.id", "token.expires")


def tree(spark: SparkSession, path: str) -> DataFrame:
    """(path, body) of an extracted export's text files, whole, by Spark's own listing and readers."""
    files = spark.read.option("wholetext", True).option("recursiveFileLookup", "true").text(path)
    return files.select(F.regexp_replace(F.col("_metadata.file_path"), r"^file:/*", "/").alias("path"), F.col("value").alias("body"))


def two_way(ascending: DataFrame, descending: DataFrame, key: str, order: str) -> DataFrame:
    """Rows of a walk that was capped at both ends, each once; which ways they were seen, in `ways`."""
    both = ascending.withColumn("way", F.lit(1)).union(descending.withColumn("way", F.lit(2)))
    cols = [c for c in ascending.columns if c != key]
    return both.groupBy(key).agg(*(F.min_by(c, order).alias(c) for c in cols), F.sum_distinct("way").alias("ways"))
