"""Pulls of a unit's parts: relations, references, outcomes, manifests of a run, and the notes beside its numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.paths import human_bytes

#: Parts of a batched request, months that are looked back for a sample, errors before a retry is recorded.
NODE_BATCH, MONTHS_BACK, NULL_SAMPLE = 50, 24, 50


def texts(items: Column, sep: str = ",") -> Column:
    """A sorted list as one text."""
    return F.array_join(F.array_sort(items), sep)


def relations(**of: DataFrame) -> DataFrame:
    """Named relations (id, parent) with a status as one relation (relation, id, parent, status)."""
    out = None
    for name, df in of.items():
        rows = df.select(F.lit(name).alias("relation"), F.col("id").cast("string").alias("id"), F.col("parent").cast("string").alias("parent"), "status")
        out = rows if out is None else out.unionByName(rows)
    return out


def legs(units: DataFrame, unit: str, rows: DataFrame, names: list[str], status: Column) -> DataFrame:
    """Each unit's legs with their count; a leg that is switched off (404) has none, one that was refused keeps its status. rows: (unit, leg)."""
    wanted = units.withColumn("leg", F.explode(F.array(*map(F.lit, names)))).withColumn("http", status)
    n = rows.groupBy(unit, "leg").agg(F.count("*").alias("n"))
    state = F.when(F.col("http") == 200, "ok").when(F.col("http") == 404, "off").otherwise(F.concat(F.lit("unavailable-"), F.col("http").cast("string")))
    return wanted.join(n, [unit, "leg"], "left").select(unit, "leg", F.when(F.col("http") == 200, F.coalesce("n", F.lit(0))).otherwise(0).alias("n"), state.alias("status"))


def references(messages: DataFrame, pattern: str, id_group: int, message_group: int) -> DataFrame:
    """Distinct (message, content) references in bodies; a message of its own in the URL is nearer than the row's."""
    hit = F.explode(F.expr(f"regexp_extract_all(body, '{pattern}', 0)")).alias("url")
    inner = F.regexp_extract("url", pattern, message_group)
    return messages.select("message", hit).select(F.when(inner != "", inner).otherwise(F.col("message").cast("string")).alias("message"), F.regexp_extract("url", pattern, id_group).alias("content")).distinct()


def nodes(documents: DataFrame, key: str, doc: str, size: str, most: int) -> DataFrame:
    """(key, node, batch, decomposed): pages of a document; those of oversized documents are asked for in batches of NODE_BATCH."""
    pages = F.transform(F.filter(F.col(doc)["children"], lambda c: c["type"] == "CANVAS"), lambda c: c["id"])
    at = documents.select(key, (F.col(size) > most).alias("decomposed"), F.posexplode(pages).alias("at", "node"))
    return at.select(key, "node", F.when(F.col("decomposed"), F.floor(F.col("at") / NODE_BATCH)).cast("long").alias("batch"), "decomposed")


def renders(pages: DataFrame, there: DataFrame, first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """What became of each page's image: present before, rendered, rendered when asked again, or null. first, second: (key, node, url)."""
    asked = pages.join(there.select(key, "node", F.lit(True).alias("there")), [key, "node"], "left")
    asked = asked.join(first.select(key, "node", F.col("url").alias("one")), [key, "node"], "left").join(second.select(key, "node", F.col("url").alias("two")), [key, "node"], "left")
    state = F.when(F.col("there"), "present").when(F.col("one").isNotNull(), "rendered").when(F.col("two").isNotNull(), "rendered-again").otherwise("null")
    return asked.groupBy(key).agg(*(F.count_if(state == s).alias(s.replace("-", "_")) for s in ("present", "rendered", "rendered-again", "null")), texts(F.slice(F.array_sort(F.collect_list(F.when(state == "null", F.col("node")))), 1, NULL_SAMPLE)).alias("nulls"))


def outcome(no_file: Column, error: Column, there: Column) -> Column:
    return F.when(no_file, "no-file").when(there, "skipped-existing").when(error.isNotNull(), "error").otherwise("copied")


def isolated(items: DataFrame, group: str, failed: DataFrame, state: Column) -> DataFrame:
    """Units of each group by outcome; a group that couldn't be listed is one row of its own and touches no other. failed: (group)."""
    good = items.join(failed.select(group), group, "left_anti").groupBy(group, state.alias("outcome")).agg(F.count("*").alias("n"))
    return good.unionByName(failed.select(group, F.lit("listing-failed").alias("outcome"), F.lit(1).cast("long").alias("n")))


def run_manifest(results: DataFrame, kind: str, *more: Column) -> DataFrame:
    """A run's units (unit, status, reason, bytes) by kind: failed and partial ones by name, skipped ones with reasons, bytes that are staged."""
    s = F.col("status")
    staged = F.sum(F.when(s.isin("ok", "skipped-complete", "partial"), F.col("bytes")))
    return results.groupBy(kind).agg(
        F.count("*").alias("units"),
        texts(F.collect_list(F.when(s == "failed", F.col("unit")))).alias("failed"),
        texts(F.collect_list(F.when(s == "partial", F.col("unit")))).alias("partial"),
        texts(F.collect_list(F.when(s == "skipped", F.concat_ws(":", "unit", "reason")))).alias("skipped"),
        F.coalesce(staged, F.lit(0)).cast("long").alias("staged"),
        *more,
    )


def failed_units(legs_: DataFrame, unit: str) -> DataFrame:
    """Units with any failed leg, and all legs' bytes."""
    return legs_.groupBy(unit).agg(F.bool_or(F.col("status") == "failed").alias("failed"), texts(F.collect_set(F.when(F.col("status") == "failed", F.col("leg")))).alias("legs"), F.coalesce(F.sum("bytes"), F.lit(0)).cast("long").alias("bytes"))


def counters(copies: DataFrame) -> DataFrame:
    """(name, n): copies (outcome, bytes, error) by outcome, their bytes, and failures by error."""
    by = copies.groupBy("outcome").agg(F.count("*").alias("n")).select("outcome", "n")
    size = copies.agg(F.lit("bytes"), F.coalesce(F.sum(F.when(F.col("outcome") == "completed", F.col("bytes"))), F.lit(0)).cast("long"))
    errors = copies.where("error is not null").groupBy(F.concat(F.lit("error:"), "error")).agg(F.count("*"))
    return by.union(size).union(errors).toDF("name", "n")


def lore(runs: DataFrame) -> DataFrame:
    """Which readings of a run's numbers its data call for, in order.

    Columns: comp, unc, prefixes (array), trusted, unmeasurable (null without deep verification), gz_uncertain (null where
    it wasn't counted), gz, parquet, bad_zips.
    """
    ratio = F.try_divide("unc", "comp")
    stamped = F.filter("prefixes", lambda p: F.rlike(p, F.lit(r"^[0-9]{8}T[0-9]{6}Z?$")))
    deep = F.col("trusted").isNotNull()
    rules = [
        (ratio.between(0.9, 1.02), F.lit("store-mode")),
        (F.size(stamped) > 0, F.concat(F.lit("timestamps:"), texts(stamped))),
        (deep & (F.col("trusted") == 0) & (F.col("unmeasurable") == 0), F.lit("verified")),
        (deep & ((F.col("trusted") > 0) | (F.col("unmeasurable") > 0)), F.concat(F.lit("residual:"), (F.col("trusted") + F.col("unmeasurable")).cast("string"))),
        (~deep & (F.col("gz_uncertain") > 0), F.concat(F.lit("gz-uncertain:"), F.col("gz_uncertain").cast("string"))),
        (~deep & F.col("gz_uncertain").isNull() & (F.col("gz") > 0), F.lit("gz-floor")),
        (F.col("parquet") > 0, F.concat(F.lit("parquet:"), F.col("parquet").cast("string"))),
        (F.col("bad_zips") > 0, F.concat(F.lit("bad-zips:"), F.col("bad_zips").cast("string"))),
    ]
    return runs.withColumn("notes", F.array_compact(F.array(*(F.when(c, x) for c, x in rules))))


def duplicate_notes(sources: DataFrame, key: str) -> DataFrame:
    """Per key: wholly redundant sources (three named), partly redundant ones with their bytes. sources: (source, unc, redundant)."""
    whole = F.col("redundant") >= F.col("unc")
    g = sources.where("redundant > 0").groupBy(key).agg(F.sum("redundant").cast("long").alias("bytes"), F.count_if(whole).alias("whole"), F.array_sort(F.collect_list(F.when(whole, F.col("source")))).alias("w"), F.array_sort(F.collect_list(F.when(~whole, F.concat_ws("=", "source", F.col("redundant").cast("string"))))).alias("p"))
    return g.select(key, "bytes", "whole", F.concat(F.array_join(F.slice("w", 1, 3), ","), F.when(F.col("whole") > 3, ",...").otherwise("")).alias("whole_names"), F.array_join("p", ",").alias("parts"))


def excluded_notes(excluded: DataFrame, key: str) -> DataFrame:
    """Per key: excluded bytes and the prefixes with their reasons. excluded: (prefix, bytes, reason)."""
    return excluded.groupBy(key).agg(F.sum("bytes").cast("long").alias("bytes"), texts(F.collect_list(F.concat(F.col("prefix"), F.lit("("), F.col("bytes").cast("string"), F.lit("):"), "reason")), "; ").alias("note"))


def unit_note(service: Column, equivalent: Column, actual: Column, note: Column) -> Column:
    """On what a percentage in the manifest's own unit rests; null where none is."""
    tb = [F.format_number(x / 1e12, n) for x, n in ((equivalent, 1), (actual, 2))]
    return F.when(equivalent.isNotNull(), F.concat(service, F.lit(": "), tb[0], F.lit(" TB of "), tb[1], F.lit(" TB as stored. "), F.coalesce(note, F.lit(""))))


def display(actual: Column, found: Column, equivalent: Column) -> Column:
    """A service's size as a table shows it: embedded and re-expressed sizes are marked."""
    return F.when((actual == 0) & (found > 0), F.concat(human_bytes(found), F.lit(" (embedded)"))).when(equivalent.isNotNull(), F.concat(human_bytes(equivalent), F.lit(" (equivalent)"))).otherwise(human_bytes(actual))


def link_gate(samples: DataFrame) -> DataFrame:
    """Sampled links (auth, status) as one verdict an auth: open, needs-auth, forbidden or gone, by what most samples say."""
    s = F.col("status")
    kind = F.when(s.isin(200, 206), "open").when(s == 401, "needs-auth").when(s == 403, "forbidden").otherwise("gone")
    n = samples.groupBy("auth", kind.alias("kind")).agg(F.count("*").alias("n"))
    return n.groupBy("auth").agg(F.max_by("kind", F.struct("n", "kind")).alias("verdict"), F.sum("n").alias("samples"))


def latest_month(files: DataFrame, now: Column) -> DataFrame:
    """The latest of the last MONTHS_BACK months that holds a pullable file: types and placeholders. files: (month, kind, pullable, placeholder)."""
    near = files.where(F.months_between(F.trunc(now, "MM"), F.col("month")).between(0, MONTHS_BACK - 1))
    last = near.where("pullable").agg(F.max("month").alias("month"))
    return near.join(F.broadcast(last), "month").groupBy("month", "kind").agg(F.count("*").alias("n"), F.count_if("placeholder").alias("placeholders"))


def first_matching(rows: DataFrame, order: str, n: int, condition: Column) -> DataFrame:
    """Whether any of the first n rows (a probe's sample) meets the condition, and how many."""
    return rows.orderBy(order).limit(n).agg(F.count("*").alias("sampled"), F.count_if(condition).alias("matching"))
