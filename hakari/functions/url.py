"""Hosts and the rules that keep portals out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import rules
from .width import narrow


def host(url: Column) -> Column:
    """Host in lower case: scheme in small letters dropped, up to the first slash, without port."""
    bare = F.regexp_replace(F.coalesce(url, F.lit("")), "^https?://", "")
    return F.split(F.lower(F.split(bare, "/")[0]), ":")[0]


def named_hosts(field: Column) -> Column:
    """The distinct hosts that a field of one or several addresses in any writing names, in its order; none for null,
    blanks and fillers. Narrow, lower case, without scheme, user, leading www., port, final dots and path."""
    parts = F.split(F.lower(narrow(F.coalesce(field, F.lit("")))), r"(?U)[\s、，,;|｜；<>()\"']+")
    at = F.transform(parts, lambda x: F.regexp_replace(F.regexp_replace(x, r"^[a-z][a-z0-9+.\-]*:/+", ""), r"[/?#\\].*$", ""))
    bare = F.transform(at, lambda x: F.regexp_replace(F.regexp_replace(F.regexp_replace(x, r"^.*@|:\d*$", ""), r"\.+$", ""), r"^www\.", ""))
    return F.array_distinct(F.filter(bare, lambda h: h.rlike(r"(?U)^[\w\-]+(\.[\w\-]+)+$")))


def blocked(url: Column, extra: list[str] | None = None, rule=rules) -> Column:
    """Whether a URL is of a portal: an extra host, a blocked suffix or word, or a blocked domain or one under it."""
    h = host(url)
    tests = [h.endswith(s) for s in rule.BLOCKED_SUFFIXES] + [h.contains(w) for w in rule.BLOCKED_WORDS]
    domain = "|".join(d.replace(".", r"\.") for d in rule.BLOCKED_DOMAINS)
    out = h.rlike(rf"(?:^|\.)(?:{domain})$")
    for t in tests:
        out = out | t
    return out | h.isin(extra) if extra else out


def blocked_for(url: Column, name: Column, extra: list[str] | None = None, rule=rules) -> Column:
    """blocked(), and municipal hosts unless the name is that of a public facility."""
    h, n = host(url), F.coalesce(name, F.lit(""))
    municipal = h.rlike(rf"(?:^|\.)(?:{'|'.join(rule.PUBLIC_LABELS)})\.")
    for s in rule.PUBLIC_SUFFIXES:
        municipal = municipal | h.endswith(s)
    return blocked(url, extra, rule) | (municipal & ~n.rlike("|".join(rule.PUBLIC_WORDS)))
