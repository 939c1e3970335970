"""Chat formatting by quotation linking; DataFrame functions only.

A line's quote level is its number of leading `>` marks. Level-0 lines are a
message's own words. Each quoted line, stripped of marks, lowered and with white
space collapsed, is hashed and meets the latest earlier message of its
conversation that has this line as its own. A message replies to the message
that most of its quoted lines come from (the later of equals), of the shallowest
quote level that meets any, or else to the message before it. Conversations are built in reply order without quotes: a
reply stands behind the message it quotes, before what follows that one.

Quotes and originals meet in one ordered pass over each (conversation, line), so
no pairs are made, and only lines that someone quotes take part. Messages that
simply follow each other form a run; only runs that a quote opened are chained
to the runs they quote, in rounds that double the distance.

Defined cases: null text is an empty message; null roles stay null; messages of
one turn (repeated rows) are ordered by role and text and keep their turn's
parent; rows without a conversation or turn are left out; an empty table gives
an empty table; further columns are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import saved, table

_MARKS = r"^(\s*>)+"

#: The same rows by DuckDB, with the lines themselves instead of hashes.
ORACLE = r"""
WITH RECURSIVE lines AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text, row_number() OVER () AS msg, string_split(coalesce(text, ''), chr(10)) AS ls
  FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL
), line AS (
  SELECT conv_id, turn, msg, pos, l, length(regexp_replace(regexp_extract(l, '^([ \t\n\x0b\f\r]*>)+'), '[ \t\n\x0b\f\r]', '', 'g')) AS level,
    trim(regexp_replace(lower(regexp_replace(l, '^([ \t\n\x0b\f\r]*>)+', '')), '[ \t\n\x0b\f\r]+', ' ', 'g'), ' ') AS normal
  FROM (SELECT conv_id, turn, msg, unnest(ls) AS l, generate_subscripts(ls, 1) AS pos FROM lines)
), message AS (
  SELECT m.conv_id, m.turn, m.role, m.msg, trim(coalesce(string_agg(l.l, chr(10) ORDER BY l.pos) FILTER (level = 0), ''), ' ') AS body,
    count(*) FILTER (level > 0 AND normal <> '') AS n_quotes, coalesce(max(level) FILTER (level > 0 AND normal <> ''), 0) AS max_level
  FROM lines m JOIN line l USING (msg) GROUP BY ALL
), own AS (SELECT DISTINCT conv_id, turn, normal FROM line WHERE level = 0 AND normal <> ''),
met AS (
  SELECT q.conv_id, q.turn, q.level, (SELECT max(o.turn) FROM own o WHERE o.conv_id = q.conv_id AND o.normal = q.normal AND o.turn < q.turn) AS origin
  FROM line q WHERE q.level > 0 AND q.normal <> ''
), link AS (
  SELECT conv_id, turn, arg_max(origin, [-level, n, origin]) AS quoted
  FROM (SELECT conv_id, turn, level, origin, count(*) AS n FROM met WHERE origin IS NOT NULL GROUP BY ALL) GROUP BY ALL
), turns AS (
  SELECT *, previous IS NULL OR (quoted IS NOT NULL AND quoted <> previous) AS opens
  FROM (SELECT conv_id, turn, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS previous FROM (SELECT DISTINCT conv_id, turn FROM lines)) LEFT JOIN link USING (conv_id, turn)
), runs AS (
  SELECT *, max(CASE WHEN opens THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn) AS run FROM turns
), path AS (
  SELECT conv_id, run, [] :: BIGINT[] AS path FROM runs WHERE previous IS NULL
  UNION ALL
  SELECT r.conv_id, r.run, list_concat(p.path, [r.quoted, r.run])
  FROM runs r JOIN runs a ON a.conv_id = r.conv_id AND a.turn = r.quoted JOIN path p ON p.conv_id = a.conv_id AND p.run = a.run
  WHERE r.opens AND r.previous IS NOT NULL
)
SELECT m.conv_id, row_number() OVER (PARTITION BY m.conv_id ORDER BY list_append(p.path, m.turn), m.role NULLS FIRST, m.body) AS position, m.turn, m.role, m.body,
  coalesce(r.quoted, r.previous) AS parent, m.n_quotes, m.max_level
FROM message m JOIN runs r USING (conv_id, turn) JOIN path p ON p.conv_id = r.conv_id AND p.run = r.run
"""


def _normal(line: F.Column) -> F.Column:
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(line, _MARKS, "")), r"\s+", " "))


def _level(line: F.Column) -> F.Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, _MARKS, 0), r"\s", ""))


def parsed(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, body, quotes array<struct<level, h>>, own array<h>) of each message."""
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    own = F.filter(lines, lambda x: _level(x) == 0)
    quoted = F.filter(lines, lambda x: _level(x) > 0)
    return messages.where(F.col("conv_id").isNotNull() & F.col("turn").isNotNull()).select(
        "conv_id",
        "turn",
        "role",
        F.trim(F.array_join(own, "\n")).alias("body"),
        F.filter(F.transform(quoted, lambda x: F.struct(_level(x).alias("level"), F.xxhash64(_normal(x)).alias("h"), (_normal(x) != "").alias("some"))), lambda x: x["some"]).alias("quotes"),
        F.array_distinct(F.transform(F.filter(own, lambda x: _normal(x) != ""), lambda x: F.xxhash64(_normal(x)))).alias("own"),
    )


def linked(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, parent): the message that each quoting turn replies to."""
    p = parsed(messages)
    quotes = p.where(F.size("quotes") > 0).select("conv_id", "turn", F.explode("quotes").alias("q")).select("conv_id", "turn", F.col("q.h").alias("h"), F.col("q.level").alias("level"))
    asked = quotes.select("conv_id", "h").distinct()
    own = p.select("conv_id", "turn", F.explode("own").alias("h")).join(asked, ["conv_id", "h"], "left_semi").distinct()
    both = own.select("conv_id", "h", "turn", F.col("turn").alias("origin"), F.lit(None).cast("int").alias("level")).union(quotes.select("conv_id", "h", "turn", F.lit(None).cast("long"), "level"))
    before = Window.partitionBy("conv_id", "h").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    asks = F.col("level").isNotNull()
    met = both.withColumn("origin", F.when(asks, F.max("origin").over(before))).where(asks & F.col("origin").isNotNull())
    votes = met.groupBy("conv_id", "turn", "level", "origin").agg(F.count("*").alias("n"))
    best = F.max(F.struct((-F.col("level")).alias("depth"), "n", "origin"))
    return votes.groupBy("conv_id", "turn").agg(best.alias("best")).select("conv_id", "turn", F.col("best.origin").alias("parent"))


def formatted(messages: DataFrame) -> DataFrame:
    """Messages in reply order: conv_id, position, turn, role, body, parent, n_quotes, max_level."""
    p = parsed(messages)
    in_turns = Window.partitionBy("conv_id").orderBy("turn")
    turns = p.select("conv_id", "turn").distinct().withColumn("previous", F.lag("turn").over(in_turns))
    links = saved(linked(messages), "links")
    turns = turns.join(links.withColumnRenamed("parent", "quoted"), ["conv_id", "turn"], "left")
    turns = turns.withColumn("opens", F.col("previous").isNull() | (F.col("quoted").isNotNull() & (F.col("quoted") != F.col("previous"))))
    turns = turns.withColumn("run", F.last(F.when(F.col("opens"), F.col("turn")), True).over(in_turns))
    turns = saved(turns, "turns")
    opened = turns.where(F.col("opens") & F.col("previous").isNotNull()).select("conv_id", "run", "quoted")
    chain = opened.join(turns.select("conv_id", F.col("turn").alias("quoted"), F.col("run").alias("above")), ["conv_id", "quoted"]).select("conv_id", "run", "above", F.array("quoted", "run").alias("path"))
    roots = turns.where(F.col("previous").isNull()).select("conv_id", F.col("turn").alias("root"))
    chain = saved(chain.join(roots, "conv_id").select("conv_id", "run", F.when(F.col("above") != F.col("root"), F.col("above")).alias("above"), "path"), "runs")
    while chain.where("above is not null").limit(1).count():
        up = chain.select("conv_id", F.col("run").alias("above"), F.col("above").alias("next"), F.col("path").alias("head"))
        chain = saved(chain.join(up, ["conv_id", "above"], "left").select("conv_id", "run", F.col("next").alias("above"), F.when(F.col("head").isNotNull(), F.concat("head", "path")).otherwise(F.col("path")).alias("path")), "runs")
    placed = turns.join(chain.select("conv_id", "run", "path"), ["conv_id", "run"], "left").select("conv_id", "turn", F.coalesce("quoted", "previous").alias("parent"), F.concat(F.coalesce("path", F.array().cast("array<bigint>")), F.array(F.col("turn"))).alias("path"))
    out = p.join(placed, ["conv_id", "turn"])
    order = Window.partitionBy("conv_id").orderBy("path", "role", "body")
    level = F.coalesce(F.array_max(F.transform("quotes", lambda q: q["level"])), F.lit(0)).cast("long")
    return out.select("conv_id", F.row_number().over(order).cast("long").alias("position"), "turn", "role", "body", "parent", F.size("quotes").cast("long").alias("n_quotes"), level.alias("max_level"))


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations in reply order, without quotes."""
    return formatted(table(spark, sf_dir, "conversations"))
