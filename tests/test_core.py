"""Golden values of the operators, and each registered query against its SQL."""

import bz2
import gzip
import io
import lzma
import math
import os
import zipfile

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerline.functions import paths as P
from ledgerline.functions import services as S
from ledgerline.operators import binary, diff, planning, reconcile
from ledgerline.plans import pulls as Q

SF = "/root/testdata/sf0.001"


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{SF}/{f}'")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, bool) or not isinstance(v, (int, float)):
        return str(v)
    return float(f"{float(v):.9g}")


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_query_equals_sql(spark, duck, name):
    df = Q.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(map(plain, r)) for r in df.select(cols).collect()), key=repr)
    r = duck.execute(Q.SQL[name])
    names = [d[0] for d in r.description]
    assert sorted(names) == cols
    assert got == sorted((tuple(plain(x[names.index(c)]) for c in cols) for x in r.fetchall()), key=repr)


@pytest.mark.parametrize(("path", "service"), [("Takeout/Mail/x.mbox", "gmail"), ("a/Google Drive/b", "gdrive"), ("a/b/c/d", None), ("one/two/three/four/slack.zip", "slack"), ("one/two/three/slack/five.zip", None), ("x//JIRA", "jira")])
def test_service_of_path(spark, path, service):
    assert one(spark, S.of_path(F.lit(path), S.matcher())) == service


def test_declared_names_win():
    assert S.matcher(["Slack EU"])["slackeu"] == "Slack EU"
    assert S.fingerprint(S.matcher()) != S.fingerprint(S.matcher(["new"]))


@pytest.mark.parametrize(("n", "text"), [(None, "—"), (5, "5 B"), (1500, "1.50 KB"), (3_665_000_000_000, "3.67 TB")])
def test_human_bytes(spark, n, text):
    assert one(spark, P.human_bytes(F.lit(n).cast("long"))) == text


def test_paths(spark):
    assert one(spark, P.dotless(F.lit("A Pvt. Ltd./Docs/f.txt"))) == "A Pvt. Ltd/Docs/f.txt"
    assert one(spark, P.site_collection(F.lit("https://X.example.com/sites/Ab/c"))) == "https://x.example.com/sites/ab"
    assert one(spark, P.safe_component(F.lit("..."))) == "unnamed"
    assert one(spark, P.md5_base64(F.lit("zz"))) is None
    assert one(spark, P.without_query_value(F.lit("https://h/p?t=1&a=2"), "t")) == "https://h/p?a=2"
    assert one(spark, P.file_path(F.lit("F012345"), F.lit(""), F.lit("png"))) == "files/F012/F012345/F012345.png"


def test_decisions(spark):
    from ledgerline.functions import decisions as D

    assert one(spark, D.body_error(F.lit('{"data":[{"code":"X"}],"code":"Y"}'))) == "X"
    assert one(spark, D.body_error(F.lit('{"code":5,"error":{"a":1}}'))) in ("", "5")
    assert one(spark, D.body_error(F.lit("garbage"))) == ""
    assert one(spark, D.body_failed(F.lit('{"status":"Failure","code":"7"}'))) == "7"
    assert one(spark, D.body_failed(F.lit('{"status":"ok"}'))) == ""
    assert one(spark, D.mapping_suspect(F.lit(10), F.lit(1000), F.lit(19))) is True
    assert one(spark, D.mapping_suspect(F.lit(10), F.lit(1000), F.lit(20))) is False
    assert [one(spark, c) for c in P.export_of_tag(F.lit("x.ZIP"))] == ["zip", "x.ZIP"]
    assert one(spark, P.safe_filename(F.lit(' a/b: "c" . '))) == "a b c "


def test_greedy_admission(spark):
    """A distributed admission equals the plain fold, ties and zero sizes too."""
    import random

    from ledgerline.operators import sizing

    r = random.Random(3)
    items = [(i, r.choice([0, 1, 5, 40, 90, 300])) for i in range(300)]
    used, want = 0, []
    for i, s in items:
        if 0 < s <= 1000 - used:
            used += s
            want.append(i)
    got = sizing.admitted(spark.createDataFrame(items, "id long, s long"), 1000, "id", "s")
    assert sorted(x["id"] for x in got.collect()) == want


def test_manifest_diff(spark):
    m = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("d", 4)], "key string, size long")
    d = spark.createDataFrame([("a", 1), ("c", 9), ("d", 4), ("e", 5)], "key string, size long")
    got = {r["key"]: r["status"] for r in diff.manifest_diff(m, d).collect()}
    assert got == {"a": "ok", "b": "MISSING-DEST", "c": "SIZE-DIFF", "d": "ok", "e": "EXTRA-DEST"}
    assert [r["key"] for r in diff.repair_list(diff.manifest_diff(m, d)).collect()] == ["b"]


def test_versions(spark):
    v = spark.createDataFrame([("k", 0, "v3", "A", True), ("k", 1, "v2", "A", False), ("k", 2, "v1", "B", False), ("k", 3, "v0", "B", False)], "key string, seq long, version string, etag string, is_latest boolean")
    assert [r["version"] for r in diff.distinct_versions(v).collect()] == ["v1"]


def test_range_bounds():
    b = planning.range_bounds(256)
    for key in ("0", "00ff", "7", "ffff", "zzz", "a0"):
        assert sum((lo == "" or key > lo) and (hi == "" or key <= hi) for lo, hi in b) == 1


def test_flags(spark):
    s = spark.createDataFrame([("a", 10300, None, 9100, 3830, 0), ("b", 100, None, None, 200, 0), ("c", 0, None, None, 5, 0), ("d", 100, None, None, 0, 50), ("e", None, 9, None, 0, 5)], "service string, declared long, records long, equivalent long, actual long, found long")
    f, pct = reconcile.flags(*(F.col(c) for c in ("declared", "records", "actual", "found", "equivalent")), F.lit(0))
    got = {r["service"]: (r["f"], r["p"] and round(r["p"], 2)) for r in s.select("service", f.alias("f"), pct.alias("p")).collect()}
    assert got == {"a": (["unit-adjusted"], 88.35), "b": (["overshoot"], 200.0), "c": (["zero-declared-has-data"], None), "d": (["found-embedded"], 50.0), "e": (["record-count", "found-embedded"], None)}


def test_archives():
    data = b"hello world " * 500
    with zipfile.ZipFile(z := io.BytesIO(), "w", zipfile.ZIP_DEFLATED) as f:
        f.writestr("a.txt", data)
        f.writestr("b.txt", b"x" * 10)
    assert binary.measure("a.zip", z.getvalue()) == (6010, "zip", "zip:2entries")
    assert binary.measure("a.zip", z.getvalue(), deep=True) == (6010, "zip", "zip-exact")
    assert binary.measure("a.gz", gzip.compress(data)) == (6000, "gz", "gz-trailer")
    assert binary.measure("a.gz", gzip.compress(data) + gzip.compress(data), deep=True) == (12000, "gz", "gz-exact")
    assert binary.measure("a.bz2", bz2.compress(data) * 2, deep=True) == (12000, "bz2", "bz2-exact")
    assert binary.measure("a.xz", lzma.compress(data), deep=True) == (6000, "xz", "xz-exact")
    assert binary.measure("a.bz2", bz2.compress(os.urandom(5000))[:-9], deep=True)[2] == "bz2-truncated"
    assert binary.measure("a.zip", b"PK\x05\x06" + b"\xff" * 40)[2].startswith("err:")
    assert binary.measure("a.txt", b"12345") == (5, "stored", "stored")


def test_readers(spark, tmp_path):
    from ledgerline.sources import readers as R

    (tmp_path / "m.tsv").write_text("a\t5\nb\t\n")
    assert {r["key"]: r["size"] for r in R.manifest(spark, str(tmp_path / "m.tsv")).collect()} == {"a": 5, "b": 0}
    (tmp_path / "i.tsv").write_text("#matcher f1\nx\te1\t5\t9\tgz-exact\t{}\nx\te2\t5\t8\tgz-exact\t{}\ny\t\t1\t1\tzip\t{}\nz\te\t1\t1\terr:X\t{}\n")
    assert [(r["name"], r["uncomp"]) for r in R.cache_index(spark, str(tmp_path / "i.tsv"), "f1").collect()] == [("x", 8)]
    assert R.cache_index(spark, str(tmp_path / "i.tsv"), "f2").count() == 0
    (tmp_path / "l.xml").write_text("<E><Blobs><Blob><Name>n</Name><Properties><Content-Length>7</Content-Length></Properties></Blob></Blobs></E>")
    assert [tuple(r) for r in R.listing_pages(spark, str(tmp_path / "l.xml")).collect()] == [("n", 7, "")]
    (tmp_path / "c.csv").write_text("Page ID,T\n1,a\n1,b\n")
    with pytest.raises(ValueError, match="more than once"):
        R.catalogue_csv(spark, str(tmp_path / "c.csv"), "Page ID", ["T"])


def test_stream_equals_batch(spark, tmp_path):
    from ledgerline.streaming import incremental as I

    rows = spark.read.parquet(f"{SF}/events.parquet").select(F.col("ts").cast("timestamp").alias("at"), "event_type", (F.col("event_id") % 10).alias("size"))
    src, out, end = (str(tmp_path / x) for x in ("src", "out", "end"))
    rows.union(spark.createDataFrame([(None, "x", 0)], rows.schema).withColumn("at", F.lit("2030-01-01").cast("timestamp"))).repartition(1).write.parquet(src)
    I.run_once(I.throughput(I.landed(spark, src, "at timestamp, event_type string, size long"), late="1 day"), out, end)
    batch = I.throughput(rows)
    # the row of 2030 moves the watermark past all windows of the events; its own stays open
    closed = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    assert closed and closed == sorted(tuple(r) for r in batch.collect())
    assert I.paced(20.0, -1e9, 0.0, 5.0, True)[0] == 10.0
    assert I.paced(10.0, 5.0, 5.0, 10.0, True)[0] == 10.0
    assert I.paced(10.0, 5.0, 5.0, 70.0, False)[0] == 10.5


def test_ranged_reads(spark, tmp_path):
    from ledgerline.operators import archives
    from ledgerline.plans.pulls import _zip64
    from ledgerline.sources import ranges

    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("slack/a", os.urandom(300_000))
        z.writestr("slack/b", b"x" * 5)
    whole = (tmp_path / "a.zip").read_bytes()
    (tmp_path / "b.zip").write_bytes(_zip64(whole, 7))
    (tmp_path / "c.zip").write_bytes(whole + b"\0" * 100_000)  # a long tail behind the end
    (tmp_path / "d.zip").write_bytes(whole[:-1])
    assert ranges.fetch(str(tmp_path / "a.zip"), 2, 5) == whole[2:6] and b"".join(ranges.chunks(str(tmp_path / "a.zip"), 1000)) == whole
    f = ranges.Ranged.of(str(tmp_path / "a.zip"), len(whole))
    assert archives.measured(f)[:2] == (300_005, "zip:2entries") and f.reads == 1
    assert zipfile.ZipFile(ranges.Ranged.of(str(tmp_path / "a.zip"), len(whole))).read("slack/b") == b"x" * 5
    rows = archives.attributed(archives.members(ranges.listed(spark, str(tmp_path))), S.matcher())
    got = {r["path"][-5]: (r["method"], r["entries"]) for r in rows.collect()}
    assert got == {"a": ("zip:2entries", {"slack": 300_005}), "b": ("zip:2entries", {"slack": 300_005}), "c": ("zip:2entries", {"slack": 300_005}), "d": ("zip-no-eocd", {})}
    plan = ranges.listed(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "content" not in plan.split("Relation")[0]


def test_publishing(spark):
    from ledgerline.sources import writers as W

    path = W.scratch(spark, "test")
    W.publish(spark.createDataFrame([("files/a", "1"), ("_meta/m", "1")], "path string, content string"), path)
    W.publish(spark.createDataFrame([("files/a", "2"), ("files/b", "2"), ("_meta/m", "2")], "path string, content string"), path)
    assert {r["path"]: r["content"] for r in W.published(spark, path).collect()} == {"files/a": "1", "files/b": "2", "_meta/m": "2"}
    lines = W.scratch(spark, "lines")
    assert W.write_lines(spark.range(7), lines) == 7
    with pytest.raises(Exception, match="exist"):
        W.write_lines(spark.range(7), lines)


def test_small_helpers(spark):
    from ledgerline.functions import decisions as D
    from ledgerline.operators import timeseries

    assert one(spark, P.library_path(F.lit("Documents"), F.lit("/drives/x/root:/A/B"), F.lit("f.txt"))).endswith("f.txt")
    assert [one(spark, timeseries.skip_reason(F.lit(m), F.lit(5), F.lit(True), forced)) for m, forced in ((5, False), (6, False), (5, True))] == ["skip", "launch", "launch"]
    assert one(spark, D.gz_uncertain(F.lit("gz"), F.lit("gz-floor"), F.lit(1))) is True and one(spark, D.row_stale(F.lit("zip"), F.lit("zip-exact"), F.lit(1), F.lit(1), deep=True)) is False


def test_stream_dedup_and_pacer(spark, tmp_path):
    from ledgerline.streaming import incremental as I

    rows = spark.createDataFrame([(f"2026-01-01 00:0{i}:00", i % 3, float(i), i % 2 == 0) for i in range(9)], "at string, key long, second double, throttle boolean").withColumn("at", F.to_timestamp("at"))
    src = str(tmp_path / "src")
    rows.repartition(1).write.parquet(src)
    stream = I.landed(spark, src, "at timestamp, key long, second double, throttle boolean")
    I.run_once(I.deduplicated(stream, ["key"]), str(tmp_path / "o1"), str(tmp_path / "c1"))
    assert sorted(r["key"] for r in spark.read.parquet(str(tmp_path / "o1")).collect()) == [0, 1, 2]
