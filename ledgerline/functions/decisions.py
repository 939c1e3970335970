"""Decision tables as CASE columns: the first rule that holds decides."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .paths import first_of, unmeasurable_ext

EXACT = ("gz-exact", "gz-truncated", "bz2-exact", "bz2-truncated", "xz-exact", "xz-truncated", "zip-exact")
GZ_LARGE, GZ_SMALL, GZ_BUDGET = 256_000_000, 8_000_000, 50_000_000_000


def decide(default: Column | str, *rules: tuple[Column, Column | str]) -> Column:
    out = F.lit(default) if isinstance(default, str) else default
    for condition, value in reversed(rules):
        out = F.when(condition, value).otherwise(out)
    return out


def starts(c: Column, *heads: str) -> Column:
    out = F.lit(False)
    for h in heads:
        out = out | F.startswith(c, F.lit(h))
    return out


def coverage_class(kind: Column, method: Column, name: Column) -> Column:
    exact_zip = method.isin("zip-exact", "zip-tiny", "zip:0entries") | starts(method, "zip-exact-mismatch")
    sure = (
        ((kind == "stored") & unmeasurable_ext(name).isNull())
        | ((kind == "zip") & exact_zip)
        | ((kind == "gz") & method.isin("gz-exact", "gz-truncated", "gz-tiny"))
        | ((kind == "parquet") & (method == "parquet-tiny"))
        | (kind.isin("bz2", "xz") & F.rlike(method, F.lit("-(exact|truncated)$")))
    )
    return decide("trusted", (starts(method, "err:"), "trusted"), (sure, "measured"), (kind == "stored", "unmeasurable"))


def method_terminal(method: Column) -> Column:
    return method.isin(*EXACT, "gz-tiny", "zip-tiny", "zip:0entries") | starts(method, "zip-exact-mismatch", "parquet")


def method_streamed(method: Column) -> Column:
    return method.isin(*EXACT) | starts(method, "zip-exact-mismatch", "zip-partial(")


def gz_stream_candidate(method: Column, clen: Column, budget: int = GZ_BUDGET, large: int = GZ_LARGE, small: int = GZ_SMALL) -> Column:
    floored = method.isin("gz-floor", "gz-bad-trailer")
    return F.lit(budget > 0) & (clen >= 4) & ((clen >= large) | (floored & (clen >= small)))


def gz_row_stale(method: Column, clen: Column, uncomp: Column, budget: int = GZ_BUDGET, large: int = GZ_LARGE, small: int = GZ_SMALL) -> Column:
    floored = method.isin("gz-floor", "gz-bad-trailer") | (uncomp == clen)
    return F.lit(budget > 0) & ~method.isin("gz-exact", "gz-truncated") & (clen >= 4) & ((clen >= large) | (floored & (clen >= small)))


def row_stale(kind: Column, method: Column, clen: Column, uncomp: Column, deep: bool = False) -> Column:
    return ~method_terminal(method) if deep else (kind == "gz") & gz_row_stale(method, clen, uncomp)


def gz_uncertain(kind: Column, method: Column, clen: Column, large: int = GZ_LARGE) -> Column:
    return (kind == "gz") & (method.isin("gz-floor", "gz-bad-trailer") | ((method == "gz-trailer") & (clen >= large)))


def file_disposition(external: Column, mode: Column, url: Column) -> Column:
    return decide("hosted", (F.coalesce(external, F.lit(False)) | (mode == "external"), "external"), (mode.isin("tombstone", "hidden_by_limit") | first_of(url).isNull(), "unavailable"))


_OK = (200, 201, 204)


def copy_outcome(status: Column, code: Column, source: Column) -> Column:
    """A server-side copy: the destination's status and code, and the source's status as text."""
    src = F.coalesce(source.try_cast("int"), F.lit(0))
    return decide(
        "fallback",
        (status.isin(200, 201, 202, 409), "ok"),
        ((src == 429) | (status == 429), "sleep"),
        (src.isin(401, 403), "source-auth"),
        (src == 404, "skip"),
        (code.isin("CannotVerifyCopySource", "CopySourceNotFound"), "resolve-again"),
        ((src >= 500) | status.isin(403, 408) | (status >= 500), "retry"),
    )


def site_outcome(status: Column) -> Column:
    return decide("skip", (status.isin(*_OK), "ok"), (status == 429, "sleep"), (status == 401, "remint"), ((status >= 500) | (status == 408), "retry"))


def directory_outcome(status: Column, family: Column, required: Column) -> Column:
    fatal = required | ((family == "messages") & status.isin(402, 403))
    return decide("retry", (status.isin(*_OK), "ok"), (status == 429, "sleep"), (status == 401, "remint"), ((status >= 500) | (status == 408), "retry"), (fatal, "fatal"), (status.isin(403, 404), "skip"))


def design_outcome(status: Column, family: Column, required: Column) -> Column:
    refused = F.when(required, "fatal").otherwise("skip")
    large = ((status == 400) & family.isin("file", "nodes")) | ((status >= 500) & (family == "file"))
    return decide(refused, (status == 429, "sleep"), (large, "decompose"), (status >= 500, "retry"))


def crm_outcome(status: Column, code: Column, required: Column) -> Column:
    refused = F.when(required, "fatal").otherwise("skip")
    absent = code.isin("NO_PERMISSION", "INVALID_MODULE", "INVALID_URL_PATTERN", "INVALID_REQUEST", "NOT_SUPPORTED", "INVALID_DATA")
    return decide(
        refused,
        (absent, "skip"),
        (code == "OAUTH_SCOPE_MISMATCH", refused),
        (code == "INTERNAL_ERROR", "retry"),
        (status == 401, "remint-once-then-fatal"),
        (status == 403, "skip"),
        (status == 429, "sleep"),
        (status >= 500, "retry"),
    )


def body_error(body: Column) -> Column:
    """The error code of a JSON body: that of its first data row, else code or error where they are texts; empty without one."""
    one = F.when(F.startswith(F.ltrim(body), F.lit("[")), F.get_json_object(body, "$[0]")).otherwise(body)
    texts = F.from_json(one, "code variant, error variant")
    plain = [F.when(F.schema_of_variant(texts[k]) == "STRING", F.nullif(F.get_json_object(one, f"$.{k}"), F.lit(""))) for k in ("code", "error")]
    return F.coalesce(F.nullif(F.get_json_object(one, "$.data[0].code"), F.lit("")), *plain, F.lit(""))


def body_failed(body: Column) -> Column:
    """The code of a body whose status or result tells of a failure, or that names an error code; else empty."""
    at = {k: F.nullif(F.get_json_object(body, f"$.{k}"), F.lit("")) for k in ("status", "result", "errorCode", "code")}
    bad = [(F.lower(at[k]).isin("failure", "error"), F.coalesce(at["errorCode"], at["code"], at[k])) for k in ("status", "result")]
    return decide(F.coalesce(at["errorCode"], F.lit("")), *bad)


def page_cap(code: Column) -> Column:
    return F.coalesce(code == "PAGINATION_LIMIT_EXCEEDED", F.lit(False))


def pullable(url: Column, kind: Column) -> Column:
    return first_of(url).isNotNull() & first_of(kind).isNotNull()


def listed(name: Column, allowed: list[str] | None) -> Column:
    """Whether an allow-list takes a name; an empty list takes all, None none."""
    return F.lit(False) if allowed is None else name.isin(allowed) if allowed else F.lit(True)


def gate(status: Column) -> Column:
    """How a probed endpoint stands: open, behind metered billing, without approval, or unexpected."""
    return decide("unexpected", (status == 200, "open"), (status == 402, "metered-model-required"), (status == 403, "protected-api-approval-missing"))


def mapping_suspect(expected: Column, present: Column, overlap: Column) -> Column:
    return (expected > 0) & (present >= 50) & (overlap < F.greatest(F.lit(5.0), 0.02 * present))


def gate_breach(missing: Column, expected: Column) -> Column:
    return F.coalesce((expected > 0) & (F.try_divide(missing, expected) > 0.01), F.lit(False))


def public_page(status: Column, protected: Column) -> Column:
    return status.isin("Live", "Accepted") & ~F.coalesce(protected, F.lit(False))


def verification_stale(ledger_at: Column, verified_at: Column) -> Column:
    return F.coalesce(ledger_at > verified_at, F.lit(False))


def wiki_absent(stderr: Column) -> Column:
    return F.rlike(F.lower(stderr), F.lit("not found|access denied|does not exist"))


def export_root(names: Column) -> Column:
    return F.array_contains(names, "channels.json") & F.array_contains(names, "users.json")


def detail_valid(detail: Column) -> Column:
    """Whether measured detail is a JSON object of service -> [bytes, files], both whole numbers."""
    pairs = F.from_json(detail, "map<string,array<bigint>>")
    shape = F.forall(F.map_values(pairs), lambda v: (F.size(v) == 2) & F.forall(v, lambda x: x.isNotNull()))
    return F.coalesce(F.startswith(F.ltrim(detail), F.lit("{")) & shape & ~F.rlike(detail, F.lit(r"[\[,]\s*(true|false)")), F.lit(False))
