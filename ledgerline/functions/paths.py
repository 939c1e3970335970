"""Column functions over object names, keys and URLs. No Python runs per row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def norm(c: Column) -> Column:
    """Lower case, only a-z and 0-9."""
    return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")


def letters_only(c: Column) -> Column:
    """Lower case, only letters and digits of any script."""
    return F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]", "")


def leaf(c: Column) -> Column:
    return F.substring_index(c, "/", -1)


def top(c: Column) -> Column:
    """The first segment, or (root) for a name without one."""
    return F.when(F.contains(c, F.lit("/")), F.substring_index(c, "/", 1)).otherwise("(root)")


def second_level(c: Column) -> Column:
    """a/b, a/(files) or (root)."""
    s = F.split(c, "/")
    return F.when(F.size(s) >= 3, F.concat_ws("/", s[0], s[1])).when(F.size(s) == 2, F.concat(s[0], F.lit("/(files)"))).otherwise("(root)")


#: Suffixes of each kind of blob.
KINDS = {"zip": (".zip",), "gz": (".gz", ".tgz"), "bz2": (".bz2", ".tbz2"), "xz": (".xz", ".txz"), "parquet": (".parquet",)}


def blob_kind(name: Column) -> Column:
    low = F.lower(name)
    out = F.lit("stored")
    for kind, ends in reversed(KINDS.items()):
        out = F.when(reduce(Column.__or__, (F.endswith(low, F.lit(e)) for e in ends)), kind).otherwise(out)
    return out


def unmeasurable_ext(name: Column) -> Column:
    return F.nullif(F.regexp_extract(F.lower(name), r"\.(7z|rar|zst|tzst)$", 0), F.lit(""))


def human_bytes(n: Column) -> Column:
    out = F.format_string("%d B", n.cast("long"))
    for unit, size in (("KB", 1e3), ("MB", 1e6), ("GB", 1e9), ("TB", 1e12)):
        out = F.when(n >= size, F.format_string(f"%.2f {unit}", n / size)).otherwise(out)
    return F.when(n.isNull(), "—").otherwise(out)


def gigabytes(n: Column) -> Column:
    return n / 1e9


def record_label(n: Column, unit: Column) -> Column:
    return F.concat_ws(" ", F.format_number(n, 0), F.coalesce(unit, F.lit("records")))


def safe_component(name: Column, limit: int = 120) -> Column:
    kept = F.regexp_replace(F.coalesce(name, F.lit("")), r"[^0-9A-Za-z._-]", "_")
    return F.substring(F.coalesce(F.nullif(F.regexp_replace(kept, r"^[._-]+|[._-]+$", ""), F.lit("")), F.lit("unnamed")), 1, limit)


def fan(file_id: Column) -> Column:
    return F.substring(file_id, 1, 4)


def file_path(file_id: Column, name: Column, ext: Column | None = None) -> Column:
    """files/<fan>/<id>/<safe name>; a nameless file is <id>.<ext> where an ext is known."""
    safe = safe_component(name)
    if ext is not None:
        safe = F.when((F.coalesce(name, F.lit("")) == "") & (F.coalesce(ext, F.lit("")) != ""), F.concat_ws(".", file_id, ext)).otherwise(safe)
    return F.concat_ws("/", F.lit("files"), fan(file_id), file_id, safe)


def rendition_path(file_id: Column, field: Column, url: Column) -> Column:
    tail = F.url_decode(leaf(F.try_parse_url(url, F.lit("PATH"))))
    return F.concat(F.lit("renditions/"), fan(file_id), F.lit("/"), file_id, F.lit("/"), field, F.lit("__"), safe_component(tail))


def conversation_kind(name: Column) -> Column:
    return F.when(F.startswith(name, F.lit("FC:")), "file_conversation").when(F.rlike(name, F.lit("^D[A-Z0-9]{7,}$")), "dm").otherwise("unknown")


def first_of(*cs: Column) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in cs))


def version_name(key: Column, version: Column) -> Column:
    return F.concat_ws("/", F.lit("_noncurrent"), key, version)


def site_collection(url: Column) -> Column:
    return F.lower(F.coalesce(F.nullif(F.regexp_extract(url, r"(?i)^(https?://[^/]+(?:/(?:sites|teams)/[^/]+)?)", 1), F.lit("")), url))


def library_path(drive: Column, parent: Column, name: Column) -> Column:
    """drive + what follows the first root: + name; null without that anchor."""
    rest = F.regexp_replace(F.substring(parent, F.instr(parent, "root:") + 5, F.lit(1 << 20)), "^/+|/+$", "")
    place = F.concat_ws("/", first_of(drive, F.lit("_no-library-name")), F.nullif(rest, F.lit("")), name)
    return F.when(F.instr(parent, "root:") > 0, place)


def dotless(path: Column) -> Column:
    """Without the dots that end segments."""
    return F.regexp_replace(path, r"\.+(?=/|$)", "")


def host_allowed(url: Column, hosts: list[str]) -> Column:
    host = F.lower(F.try_parse_url(url, F.lit("HOST")))
    ok = reduce(Column.__or__, ((host == h) | F.endswith(host, F.lit(f".{h}")) for h in hosts))
    return F.coalesce(F.rlike(url, F.lit("^https?://")) & ok, F.lit(False))


def query_value(url: Column, name: str) -> Column:
    return F.nullif(F.regexp_extract(url, rf"[?&]{name}=([^&#]*)", 1), F.lit(""))


def without_query_value(url: Column, name: str) -> Column:
    """The URL without one query parameter; the others keep their order."""
    cut = F.regexp_replace(url, rf"([?&]){name}=[^&#]*(&?)", "$1")
    return F.regexp_replace(F.regexp_replace(cut, r"\?&", "?"), r"[?&](?=#|$)", "")


def with_query_value(url: Column, name: str, value: Column) -> Column:
    put = F.concat(url, F.when(F.contains(url, F.lit("?")), "&").otherwise("?"), F.lit(f"{name}="), value)
    return F.when(value.isNull() | query_value(url, name).isNotNull(), url).otherwise(put)


def md5_base64(hexes: Column) -> Column:
    return F.when(F.rlike(hexes, F.lit("^[0-9A-Fa-f]{32}$")), F.base64(F.unhex(hexes)))


def block_id(i: Column, width: int = 8) -> Column:
    return F.base64(F.lpad(i.cast("string"), width, "0").cast("binary"))


def encoded_twice(c: Column) -> Column:
    def once(x: Column) -> Column:
        return F.replace(F.replace(F.url_encode(x), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A"))

    return once(once(c))


def safe_uuid(c: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_replace(F.translate(c, "/+", "_-"), "[^0-9A-Za-z_-]", ""), F.lit("")), F.lit("unknown"))


def safe_filename(c: Column, limit: int = 150) -> Column:
    clean = F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), r'[\\/:*?"<>|\x00-\x1f]+', " "), r"\s+", " "))
    return F.coalesce(F.nullif(F.substring(F.regexp_replace(clean, r"^\.+|\.+$", ""), 1, limit), F.lit("")), F.lit("video"))


#: Extensions by content type.
EXTENSIONS = {"image/png": ".png", "image/jpeg": ".jpg", "image/gif": ".gif", "image/webp": ".webp", "image/svg+xml": ".svg", "application/pdf": ".pdf", "video/mp4": ".mp4"}


def extension_of_type(content_type: Column) -> Column:
    clean = F.lower(F.trim(F.substring_index(F.coalesce(content_type, F.lit("")), ";", 1)))
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in EXTENSIONS.items() for x in kv)), clean), F.lit(""))


def extension_of_url(url: Column) -> Column:
    return F.coalesce(F.nullif(F.lower(F.regexp_extract(F.try_parse_url(url, F.lit("PATH")), r"\.[A-Za-z0-9]{2,6}$", 0)), F.lit("")), F.lit(".mp4"))


def tail_id(uri: Column) -> Column:
    return F.nullif(F.substring_index(leaf(uri), ":", 1), F.lit(""))


def pdf_token(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, r"/pdf/([^/?#]+)/?$", 1), F.lit(""))


def list_digest(items: Column) -> Column:
    return F.sha1(F.array_join(items, ",").cast("binary"))


def chunked(fields: Column, size: int = 50) -> Column:
    """Distinct fields without id, in chunks of at most `size`, each led by id."""
    rest = F.array_remove(F.array_distinct(fields), "id")
    step = size - 1
    starts = F.sequence(F.lit(1), F.greatest(F.size(rest), F.lit(1)), F.lit(step))
    return F.transform(starts, lambda s: F.concat(F.array(F.lit("id")), F.slice(rest, s, F.lit(step))))


def export_tag(kind: Column, place: Column) -> Column:
    """An export's tag, <kind>:<place>."""
    return F.concat_ws(":", kind, place)


def export_of_tag(tag: Column) -> tuple[Column, Column]:
    """Kind and place of a tag; a bare .zip name is an archive, any other bare text a tree."""
    tagged = F.rlike(tag, F.lit("^(zip|tree):"))
    kind = F.when(tagged, F.substring_index(tag, ":", 1)).when(F.endswith(F.lower(tag), F.lit(".zip")), "zip").when(tag != "", "tree").otherwise("")
    return kind, F.when(tagged, F.regexp_replace(tag, "^(zip|tree):", "")).otherwise(tag)


#: Extensions by recording type.
RECORDINGS = {"MP4": "mp4", "M4A": "m4a", "TRANSCRIPT": "vtt", "CHAT": "txt", "CC": "vtt", "CSV": "csv", "TIMELINE": "json", "SUMMARY": "json"}


def recording_path(prefix: str, meeting: Column, start: Column, kind: Column, ext: Column, file_id: Column) -> Column:
    """<prefix>/meetings/<meeting>/<start>_<TYPE>_<first 12 of the id>.<ext>."""
    up = F.upper(F.coalesce(first_of(kind), F.lit("FILE")))
    known = F.try_element_at(F.create_map(*(F.lit(x) for kv in RECORDINGS.items() for x in kv)), up)
    name = F.concat_ws("_", F.regexp_replace(F.coalesce(start, F.lit("")), "[:-]", ""), up, F.substring(F.coalesce(file_id, F.lit("")), 1, 12))
    return F.concat(F.lit(f"{prefix}/meetings/"), safe_uuid(meeting), F.lit("/"), name, F.lit("."), F.coalesce(known, first_of(F.lower(ext)), F.lit("bin")))


def unit_label(kind: Column, owner: Column, key: Column, name: Column) -> Column:
    """meta, library/<owner> or files/<owner>/<key>__<name>: the key comes before the name, which may change."""
    return F.when(kind == "meta", "meta").when(kind == "library", F.concat(F.lit("library/"), safe_component(owner))).otherwise(F.concat(F.lit("files/"), safe_component(owner), F.lit("/"), key, F.lit("__"), safe_component(name)))


def iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def iso_basic(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd'T'HHmmss'Z'")


def parse_iso(c: Column) -> Column:
    """Strict; other forms are null."""
    return F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'"))


#: Parameters that carry a workspace's token, and how tokens begin.
TOKEN_PARAMS, TOKEN_HEAD = ("token", "t"), "xox"
_TOKEN = r"[?&](token|t)=xox[^&#]*"


def embedded_token(url: Column) -> Column:
    """The token in a URL's query, or null; other values of the same parameters are none."""
    values = (query_value(url, p) for p in TOKEN_PARAMS)
    return F.coalesce(*(F.when(F.startswith(v, F.lit(TOKEN_HEAD)), v) for v in values))


def token_param(url: Column) -> Column:
    """The parameter that carries it (the last one of several), or null."""
    return F.nullif(F.regexp_extract(url, ".*" + _TOKEN, 1), F.lit(""))


def token_free(url: Column) -> Column:
    """The URL without it; other parameters and the fragment stay."""
    first = F.regexp_replace(url, r"(\?)(?:(?:token|t)=xox[^&#]*&?)+", "$1")
    rest = F.regexp_replace(first, r"&(?:token|t)=xox[^&#]*", "")
    return F.regexp_replace(rest, r"\?(#|$)", "$1")


def with_token(url: Column, param: Column, token: Column) -> Column:
    """The inverse of token_free: without a known parameter `token` is taken, and a URL that has a token stays as it is."""
    usual = param.isNull() | (param == TOKEN_PARAMS[0])
    name = F.coalesce(param, F.lit(TOKEN_PARAMS[0]))
    put = F.concat(url, F.when(F.contains(url, F.lit("?")), "&").otherwise("?"), name, F.lit("="), F.url_encode(token))
    return F.when(token.isNull() | (token == "") | (url == "") | (usual & embedded_token(url).isNotNull()), url).otherwise(put)
