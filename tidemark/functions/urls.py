"""URL rules as column expressions: hosts, allow-lists, links and query parameters."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))


def host(url: Column) -> Column:
    """Lower-case host without user info and port; empty when there is none."""
    pattern = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?(?:\[([^\]/?#]*)\]|([^:/?#]*))"
    return F.lower(F.concat(F.regexp_extract(url, pattern, 1), F.regexp_extract(url, pattern, 2)))


def read_allowed(lines: Iterable[str]) -> list[str]:
    """Entries of an allow-list: blank lines and ``#`` lines are comments."""
    entries = (line.strip() for line in lines)
    return sorted({entry.lower() for entry in entries if entry and not entry.startswith("#")})


def is_allowed(url: Column, allowed: Iterable[str]) -> Column:
    """True when the URL equals an entry, or is http(s) with a host the list names.

    ``*.suffix`` names the strict subdomains of ``suffix``. The list is configuration, so it
    goes into the expression and the check needs no join.
    """
    entries = sorted(set(allowed))
    value = F.regexp_replace(url, r"^\s+|\s+$", "")
    hosts = [entry for entry in entries if "://" not in entry]
    exact = [re.escape(entry) for entry in hosts]
    below = [r".*\." + re.escape(entry[2:]) for entry in hosts if entry.startswith("*.")]
    named = F.lit(False)
    if hosts:
        named = scheme(value).isin("http", "https") & host(value).rlike(f"^(?s:{'|'.join(exact + below)})$")
    literal = value.isin(entries) if entries else F.lit(False)
    return F.coalesce((value != "") & (literal | named), F.lit(False))


def without_dots(path: Column) -> Column:
    """A path that starts with a slash, with its ``.`` and ``..`` segments resolved."""
    parts = F.split(path, "/")
    last = F.element_at(parts, -1)

    def step(kept: Column, part: Column) -> Column:
        return (
            F.when(part == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0))))
            .when(part == ".", kept).otherwise(F.concat(kept, F.array(part)))
        )

    kept = F.aggregate(F.slice(parts, 2, F.size(parts)), F.array().cast("array<string>"), step)
    # A path that ends with a dot segment names a folder.
    tail = F.when(last.isin(".", "..") & (F.size(kept) > 0), "/").otherwise("")
    resolved = F.concat(F.lit("/"), F.array_join(kept, "/"), tail)
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), resolved).otherwise(path)


def join_url(base: Column, link: Column) -> Column:
    """Absolute form of a link found on the page at ``base``; dot segments are resolved."""
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    path = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    folder = F.regexp_replace(path, r"[^/]*$", "")
    folder = F.when(folder == "", "/").otherwise(folder)
    own, rest = F.regexp_extract(link, r"^([^?#]*)", 1), F.regexp_extract(link, r"^[^?#]*(.*)$", 1)
    aimed = F.when(own.startswith("/"), own).otherwise(F.concat(folder, own))
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(scheme(base), F.lit(":"), link))
        .when(link.startswith("?"), F.concat(origin, path, link))
        .otherwise(F.concat(origin, without_dots(aimed), rest))
    )


# Parts of a Link header: a target, then parameters whose value may be quoted.
_TARGET = r"<[^>]*>"
_PARAMETER = r"""\s*;\s*[^\s=;,"]+(?:\s*=\s*(?:"[^"]*"|[^\s;,"]*))?"""


def header_link(header: Column, relation: str) -> Column:
    """Target of the first link of a Link header that has a relation; empty when there is none.

    Links are separated first, then their parameters: the relation may stand at any place, and its
    value is a list of relations in any case.
    """
    links = F.regexp_extract_all(F.coalesce(header, F.lit("")), F.lit(f"{_TARGET}(?:{_PARAMETER})*"), F.lit(0))

    def relations(link: Column) -> Column:
        """The value of the first parameter named rel."""
        parameters = F.regexp_extract_all(F.regexp_replace(link, f"^{_TARGET}", ""), F.lit(_PARAMETER), F.lit(0))
        named = F.filter(parameters, lambda text: F.lower(text).rlike(r"^\s*;\s*rel\s*="))
        value = F.regexp_replace(F.get(named, F.lit(0)), r"^[^=]*=\s*", "")
        return F.split(F.trim(F.lower(F.translate(value, '"', ""))), r"\s+")

    wanted = F.filter(links, lambda link: F.coalesce(F.array_contains(relations(link), relation), F.lit(False)))
    return F.coalesce(F.regexp_extract(F.get(wanted, F.lit(0)), "^<([^>]*)>", 1), F.lit(""))


def query_param(url: Column, name: str) -> Column:
    """Value of a query parameter, NULL when it is absent."""
    pattern = rf"[?&]{name}=([^&#]*)"
    return F.when(url.rlike(pattern), F.regexp_extract(url, pattern, 1))


def with_query_param(url: Column, name: Column, value: Column) -> Column:
    """The URL with one query parameter set, in its old place when it was there before."""
    bare = F.regexp_replace(url, r"#.*$", "")
    pattern = F.concat(F.lit(r"([?&])"), name, F.lit(r"=[^&]*"))
    setting = F.concat(name, F.lit("="), value)
    return (
        F.when(
            F.regexp_like(bare, pattern),
            F.regexp_replace(bare, pattern, F.concat(F.lit("$1"), setting)),
        )
        .when(bare.endswith("?") | bare.endswith("&"), F.concat(bare, setting))
        .when(F.instr(bare, "?") > 0, F.concat(bare, F.lit("&"), setting))
        .otherwise(F.concat(bare, F.lit("?"), setting))
    )
