"""URL resolution as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions import text as t

# RFC 3986, appendix B.
_PARTS = r"^([a-zA-Z][a-zA-Z0-9+.-]*:)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?$"


def parts(url: Column) -> Column:
    """[scheme, host, path, query, fragment], each with its own punctuation, '' where absent."""
    return F.split(F.regexp_replace(url, _PARTS, "$1\x00$2\x00$3\x00$4\x00$5"), "\x00", 5)


def _without_dots(path: Column) -> Column:
    """Fold '.' and '..' segments away."""
    segments = F.split(path, "/")
    kept = F.aggregate(
        segments, F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(s == ".", acc).otherwise(F.array_append(acc, s)))
    tail = F.when(path.rlike(r"(^|/)\.\.?$"), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    return F.array_join(F.concat(kept, tail), "/")


def resolve(base: Column, link: Column, base_parts: Column | None = None) -> Column:
    """``link`` as seen from the page at ``base``; same result as the standard library's urljoin.

    For many links of one page, ``base_parts`` is ``parts(base)`` taken once.
    """
    given = F.regexp_replace(link, r"^[\x00-\x20]+|[\t\r\n]", "")
    taken = t.let(given, lambda u: F.struct(u.alias("link"), base.alias("base"), parts(u).alias("l"), (parts(base) if base_parts is None else base_parts).alias("b")))
    # The two shapes nearly all links have need no taking apart.
    return (F.when(link.isNull(), link).when(link.rlike(r"^https?://[^\t\r\n]*\z"), link)
            .when(link.rlike(r"^(?!//|[^?#]*/\.)/[^\t\r\n]*\z"),
                  F.concat(F.regexp_extract(base, r"^[^:/?#]+://[^/?#]*", 0) if base_parts is None else F.concat(base_parts[0], base_parts[1]), link))
            .otherwise(t.let(taken, _joined)))


def _joined(p: Column) -> Column:
    link, scheme, host, path = p["link"], p["b"][0], p["b"][1], p["l"][2]
    folder = F.regexp_replace(p["b"][2], r"[^/]*$", "")
    full = F.when(path.startswith("/"), path).otherwise(
        F.regexp_replace(F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), path), r"(?<=.)/{2,}", "/"))
    plain = t.let(full, lambda j: F.when(j.rlike(r"(^|/)\.\.?(/|$)"), _without_dots(j)).otherwise(j))
    rooted = F.regexp_replace(plain, "^(?!/)", "/")
    return (F.when(link == "", p["base"])
            .when(p["l"][0] != "", link)
            .when(p["l"][1] != "", F.concat(scheme, link))
            .when(path == "", F.concat(scheme, host, p["b"][2], F.when(p["l"][3] != "", p["l"][3]).otherwise(p["b"][3]), p["l"][4]))
            .otherwise(F.concat(scheme, host, rooted, p["l"][3], p["l"][4])))
