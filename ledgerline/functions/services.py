"""Which service a path belongs to."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .paths import norm

#: Services and the normalised names that mean them.
CATALOGUE = {
    "gdrive": ("gdrive", "googledrive", "drive", "takeout"),
    "gmail": ("gmail", "googlemail"),
    "gcal": ("gcal", "googlecalendar"),
    "slack": ("slack",),
    "hubspot": ("hubspot",),
    "salesforce": ("salesforce", "sfdc"),
    "zendesk": ("zendesk",),
    "notion": ("notion",),
    "jira": ("jira",),
    "confluence": ("confluence",),
    "github": ("github",),
    "gitlab": ("gitlab",),
    "figma": ("figma",),
    "asana": ("asana",),
    "intercom": ("intercom",),
    "stripe": ("stripe",),
    "quickbooks": ("quickbooks",),
    "dropbox": ("dropbox",),
    "sharepoint": ("sharepoint",),
    "onedrive": ("onedrive",),
    "teams": ("msteams", "microsoftteams"),
    "zoom": ("zoom",),
    "airtable": ("airtable",),
}
#: What the folder under a takeout folder means.
UNDER_TAKEOUT = {
    "mail": "gmail",
    "drive": "gdrive",
    "calendar": "gcal",
    "chat": "gchat",
    "googlechat": "gchat",
    "contacts": "gcontacts",
    "groups": "ggroups",
    "keep": "gkeep",
    "meet": "gmeet",
    "photos": "gphotos",
    "googlephotos": "gphotos",
    "tasks": "gtasks",
    "voice": "gvoice",
    "youtubeandyoutubemusic": "youtube",
}


def matcher(declared: list[str] = ()) -> dict[str, str]:
    """Alias -> service. Declared names come last and keep their own spelling."""
    out = {alias: service for service, aliases in CATALOGUE.items() for alias in aliases}
    for name in declared:
        key = "".join(ch for ch in name.lower() if ch.isascii() and ch.isalnum())
        if key:
            out[key] = name
    return out


def fingerprint(aliases: dict[str, str]) -> str:
    """Changes with any alias; keys caches of detected services."""
    import hashlib
    import json

    return hashlib.sha1(json.dumps([sorted(aliases.items()), sorted(UNDER_TAKEOUT.items())], separators=(",", ":")).encode()).hexdigest()[:12]


def _lookup(values: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for kv in values.items() for x in kv))


def of_segment(segment: Column, aliases: dict[str, str]) -> Column:
    """The whole segment's service, or that of its first token that has one."""
    known = _lookup(aliases)
    tries = F.concat(F.array(norm(segment)), F.filter(F.split(F.lower(segment), "[^a-z0-9]+"), lambda x: x != ""))
    return F.try_element_at(F.filter(F.transform(tries, lambda x: F.try_element_at(known, x)), lambda x: x.isNotNull()), F.lit(1))


def of_path(path: Column, aliases: dict[str, str]) -> Column:
    """The deepest match among the first three segments and the last one."""
    known, children = _lookup(aliases), _lookup(UNDER_TAKEOUT)
    s = F.filter(F.split(path, "/"), lambda x: x != "")
    places = F.when(F.size(s) > 3, F.array(F.size(s) - 1, F.lit(2), F.lit(1), F.lit(0))).otherwise(F.reverse(F.sequence(F.lit(0), F.greatest(F.size(s) - 1, F.lit(0)))))

    def at(i: Column) -> Column:
        here = F.get(s, i)
        child = F.try_element_at(children, norm(F.get(s, i + 1)))
        inner = F.when(norm(here) == "takeout", F.coalesce(F.try_element_at(known, child), child))
        hit = of_segment(here, aliases)
        return F.when(hit.isNotNull(), F.coalesce(inner, hit))

    return F.try_element_at(F.filter(F.transform(places, at), lambda x: x.isNotNull()), F.lit(1))
