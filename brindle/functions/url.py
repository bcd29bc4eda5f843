"""URL and domain normalisation as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Query keys that only track a visit. Keys that start with utm_ count too.
TRACKING_KEYS = ["fbclid", "gclid", "dclid", "msclkid", "igshid", "mc_cid", "mc_eid", "share"]

_SPLIT = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"


def url_part(url: Column, part: str) -> Column:
    """scheme, netloc, path or query of a URL; '' where absent. Unlike parse_url it never raises."""
    return F.regexp_extract(url, _SPLIT, {"scheme": 1, "netloc": 2, "path": 3, "query": 4}[part])


def _decoded(x: Column) -> Column:
    return F.coalesce(F.try_url_decode(x), x)


def _encoded(x: Column) -> Column:
    """Form encoding with '~' as it is and '*' encoded."""
    return F.replace(F.replace(F.url_encode(x), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def normalize_url(url: Column) -> Column:
    """One spelling per page: trimmed, scheme and host in lower case, no fragment, no tracking keys, the other
    query pairs sorted and in one encoding, '/' for an empty path. Null and blank URLs give ''."""
    raw = F.trim(F.coalesce(url, F.lit("")))
    query = url_part(raw, "query")
    pairs = F.transform(
        F.filter(F.split(query, "&"), lambda p: F.length(p) > 0),
        lambda p: F.struct(_decoded(F.regexp_extract(p, "^([^=]*)", 1)).alias("k"), _decoded(F.regexp_replace(p, "^[^=]*=?", "")).alias("v")),
    )
    kept = F.filter(pairs, lambda p: ~(F.lower(p["k"]).startswith("utm_") | F.lower(p["k"]).isin(*TRACKING_KEYS)))
    text = F.array_join(F.transform(F.array_sort(kept), lambda p: F.concat(_encoded(p["k"]), F.lit("="), _encoded(p["v"]))), "&")
    path = url_part(raw, "path")
    scheme, netloc = F.lower(url_part(raw, "scheme")), F.lower(url_part(raw, "netloc"))
    return F.when(raw == "", raw).otherwise(
        F.concat(
            F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(F.lit("")),
            F.when(netloc != "", F.concat(F.lit("//"), netloc)).otherwise(F.lit("")),
            F.when(path == "", F.lit("/")).otherwise(path),
            F.when(F.size(kept) > 0, F.concat(F.lit("?"), text)).otherwise(F.lit("")),
        )
    )


def url_host(url: Column) -> Column:
    """Host in lower case without user, port, final dot and one leading 'www.'."""
    host = F.regexp_replace(F.lower(url_part(F.trim(url), "netloc")), r"^.*@|:\d*$", "")
    return F.regexp_replace(F.regexp_replace(host, r"\.+$", ""), r"^www\.", "")


def normalize_domain(domain: Column) -> Column:
    """A host name in one spelling, or null for what is no public host name.

    Blanks, case, a scheme, path, port, final dot and one leading 'www.' do not count. Null: empty names, names
    with user information, without a dot, with an empty or over-long label, and IP addresses. Names beyond ASCII
    stay in their Unicode spelling.
    """
    raw = F.trim(domain)
    full = F.when(raw.contains("://"), raw).otherwise(F.concat(F.lit("https://"), raw))
    netloc = F.lower(F.trim(url_part(full, "netloc")))
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(netloc, r":\d*$", ""), r"[.\s]+$", ""), r"^www\.", "")
    label = r"[^.\s\[\]:]{1,63}"
    good = host.rlike(rf"^{label}(?:\.{label})+$") & (F.length(host) <= 253) & ~netloc.contains("@") & ~host.rlike(r"^\d{1,3}(?:\.\d{1,3}){3}$")
    return F.when(good, host)
