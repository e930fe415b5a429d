"""URL expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def source_domain(url: Column) -> Column:
    """Lower-cased host; null for a null url, empty when there is no host."""
    host = F.regexp_replace(F.try_parse_url(url, F.lit("HOST")), r"^.*@", "")
    return F.when(url.isNotNull(), F.coalesce(F.lower(host), F.lit("")))


def without_www(domain: Column) -> Column:
    return F.regexp_replace(F.lower(domain), r"^www\.", "")


def absolute_url(href: Column, base: Column) -> Column:
    """Resolve a root-relative link against the scheme and host of ``base``."""
    root = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]+)", 1)
    return F.when(href.startswith("/"), F.concat(root, href)).otherwise(href)
