"""HTML character references as a native expression."""

from __future__ import annotations

import json
import re
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions import text as t

_REFERENCE = r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);?"
# Names that count without a semicolon too; the longest one wins.
_BARE = "|".join(sorted((re.escape(n) for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n)))


def _table(entries: dict) -> Column:
    """A map that the optimizer folds into one literal."""
    return F.from_json(F.lit(json.dumps(entries)), "map<string,string>")


def _listed(entries: dict[str, str]) -> str:
    """Names and what they stand for as one text, so that the plan holds one literal instead of thousands."""
    return "".join(f"\x00{n}\x01{c}" for n, c in entries.items()) + "\x00"


_NAMES, _BARE_NAMES = _listed(html5), _listed({n: c for n, c in html5.items() if not n.endswith(";")})


def _named(name: Column, listed: str = _NAMES) -> Column:
    """What a name stands for, NULL for others."""
    at = F.instr(F.lit(listed), F.concat(F.lit("\x00"), name, F.lit("\x01")))
    return t.let(at, lambda i: F.when(i > 0, F.substring_index(F.substr(F.lit(listed), i + F.length(name) + 2, F.lit(4)), "\x00", 1)))


def _character(code: Column) -> Column:
    """A code point as text; what numeric references may not name becomes what browsers show for it."""
    old = {n: bytes([n]).decode("cp1252", "replace") for n in range(0x80, 0xA0)}
    old = {n: chr(n) if c == "\ufffd" else c for n, c in old.items()} | {0x0D: "\r", 0: "\ufffd"}
    control = ((code >= 1) & (code <= 8)) | (code == 11) | ((code >= 14) & (code <= 31)) | (code == 127) | ((code >= 0xFDD0) & (code <= 0xFDEF)) | ((code % 65536) >= 65534)
    plain = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return (F.when(code.isNull() | (code > 0x10FFFF) | ((code >= 0xD800) & (code <= 0xDFFF)), F.lit("\ufffd"))
            .when(code.isin(list(old)), F.try_element_at(_table(old), code.cast("string"))).when(control, F.lit("")).otherwise(plain))


def _decoded(ref: Column) -> Column:
    decimal = F.regexp_extract(ref, "^&#([0-9]+)", 1).try_cast("bigint").try_cast("int")
    hexadecimal = F.when(F.length(F.regexp_extract(ref, "^&#[xX]0*([0-9a-fA-F]*)", 1)) <= 7, F.conv(F.regexp_extract(ref, "^&#[xX]([0-9a-fA-F]+)", 1), 16, 10).try_cast("int"))
    name = F.substring(ref, 2, 64)
    known = t.let(name, lambda n: _named(n))
    begun = t.let(F.regexp_extract(name, f"^(?:{_BARE})", 0),
                  lambda prefix: F.when(prefix != "", F.concat(_named(prefix, _BARE_NAMES), F.substr(ref, F.length(prefix) + 2))))
    return (F.when(ref == "&amp;", "&").when(ref.rlike("^&#[xX]"), t.let(hexadecimal, _character)).when(ref.startswith("&#"), t.let(decimal, _character))
            .otherwise(F.coalesce(known, begun, ref)))


def unescape(c: Column) -> Column:
    """Decimal, hexadecimal and named references decoded; same result as the standard library's html.unescape."""
    return t.let(c, _unescaped)


def _unescaped(c: Column) -> Column:
    gaps, refs = F.split(c, _REFERENCE, -1), F.regexp_extract_all(c, F.lit(_REFERENCE), F.lit(0))
    both = F.zip_with(gaps, F.transform(refs, _decoded), lambda gap, ref: F.concat(gap, F.coalesce(ref, F.lit(""))))
    return (F.when(~F.contains(c, F.lit("&")), c).when(~c.rlike("&(?!amp;)"), F.replace(c, F.lit("&amp;"), F.lit("&")))
            .otherwise(F.array_join(both, "")))
