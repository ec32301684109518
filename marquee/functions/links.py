"""Links: host, resolution against the page, allowed domains."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def link_host(url: Column) -> Column:
    """The text between the second and third slash, as shown for a stream link."""
    return F.try_element_at(F.split(url, "/"), F.lit(3))


def without_dots(url: Column) -> Column:
    """``url`` with ``.`` and ``..`` segments of its path folded, as RFC 3986 removes them."""
    root = F.regexp_extract(url, r"^([a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*)", 1)
    path = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    rest = F.regexp_extract(url, r"^[^?#]*(.*)$", 1)
    segments = F.split(path, "/", -1)

    def fold(kept: Column, segment: Column) -> Column:
        up = F.when(F.size(kept) > 1, F.slice(kept, F.lit(1), F.size(kept) - 1)).otherwise(kept)
        return F.when(segment == ".", kept).when(segment == "..", up).otherwise(F.concat(kept, F.array(segment)))

    folded = F.aggregate(segments, F.array().cast("array<string>"), fold)
    last = F.element_at(segments, -1)
    closed = F.when(last.isin(".", ".."), F.concat(folded, F.array(F.lit("")))).otherwise(folded)
    dotted = (root != "") & path.rlike(r"(^|/)\.\.?(/|$)")
    return F.when(dotted, F.concat(root, F.array_join(closed, "/"), rest)).otherwise(url)


def page_address(url: Column) -> Column:
    """The address of the page behind a URL: without fragment; NULL when it is not one of http or https."""
    bare = F.regexp_replace(url, "#.*$", "")
    return F.when(bare.rlike("^(?i:https?)://"), bare)


def absolute(link: Column, page_url: Column) -> Column:
    """Resolve ``link`` against the URL of the page it was found on; NULL for a URL that cannot be read."""
    scheme = F.regexp_extract(page_url, r"^([a-zA-Z][a-zA-Z0-9+.\-]*):", 1)
    root = F.regexp_extract(page_url, r"^([a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*)", 1)
    bare = F.regexp_extract(page_url, r"^([^?#]*)", 1)
    folder = F.regexp_extract(page_url, r"^([a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*(?:/[^?#]*)?)/[^/?#]*(?:[?#].*)?$", 1)
    folder = F.when(folder == "", root).otherwise(folder)
    plain = (
        F.when(link.rlike(r"^[a-zA-Z][a-zA-Z0-9+.\-]*:"), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(root, link))
        .when(link == "", page_url)
        .when(link.startswith("?"), F.concat(bare, link))
        .when(link.startswith("#"), F.concat(F.regexp_extract(page_url, r"^([^#]*)", 1), link))
        .otherwise(F.concat(folder, F.lit("/"), link))
    )
    # A link with a scheme of its own and one that stays on the page keep their path as it is written.
    kept = link.rlike(r"^[a-zA-Z][a-zA-Z0-9+.\-]*:(?!//)") | (link == "") | link.startswith("#") | link.startswith("?")
    return F.when(root != "", F.when(kept, plain).otherwise(without_dots(plain)))


def host(url: Column) -> Column:
    """Lower-case host without user name and port; NULL when the URL has none."""
    found = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.nullif(F.lower(found), F.lit(""))


def in_domains(url: Column, domains: list[str]) -> Column:
    """True when the host is one of ``domains`` or a sub-domain of one."""
    name = host(url)
    allowed = F.lit(False)
    for domain in domains:
        allowed = allowed | (name == domain.lower()) | name.endswith("." + domain.lower())
    return F.coalesce(allowed, F.lit(False))
