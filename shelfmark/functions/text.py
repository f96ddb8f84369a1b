"""Scalar functions as ``Column -> Column``; every one is total (no ANSI errors) and JVM-side."""

from __future__ import annotations

import re
import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.patterns import SPACE, java

# Decimal digits of every script, so that numbers in Devanagari and others are read too.
_DIGITS = "".join(c for c in map(chr, range(128, sys.maxunicode + 1)) if unicodedata.category(c) == "Nd")
_DIGIT_VALUES = "".join(str(unicodedata.decimal(c)) for c in _DIGITS)


def let(c: Column, use) -> Column:
    """``use(c)`` with ``c`` named once, however often ``use`` mentions it; keeps plans small."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def keep_if(c: Column, test) -> Column:
    """The value where ``test`` holds, otherwise NULL; names ``c`` once."""
    return F.get(F.filter(F.array(c), test), F.lit(0))


def settled(c: Column) -> Column:
    """The column itself, marked as depending on where it runs.

    A later filter or explode then tests the finished value; pushed below, it would evaluate the whole rule chain a second time.
    """
    return F.when(F.spark_partition_id() >= 0, c)


def truthy(c: Column) -> Column:
    """The value, or NULL where Python would call it false: '' for text."""
    return F.nullif(c, F.lit(""))


def nonzero(c: Column) -> Column:
    return F.nullif(c, F.lit(0).cast("double"))


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"(?U)^[{SPACE}]+|(?<![{SPACE}])[{SPACE}]+\\z", "")


def clean_text(c: Column) -> Column:
    """Trim, collapse any Unicode whitespace to one space, empty becomes NULL."""
    # Lone spaces, by far the most common gap, are no match and stay as they are.
    return truthy(F.trim(F.regexp_replace(c, f"(?U) [{SPACE}]+|[{SPACE}&&[^ ]][{SPACE}]*", " ")))


def search(c: Column, pattern: str, ignore_case: bool = False, group: int = 1) -> Column:
    """First match's group, NULL when there is none (or it is empty)."""
    return truthy(F.regexp_extract(c, java(pattern, ignore_case), group))


def found(c: Column, pattern: str, ignore_case: bool = False) -> Column:
    return c.rlike(java(pattern, ignore_case))


def substitute(c: Column, pattern: str, replacement: str, ignore_case: bool = False) -> Column:
    return F.regexp_replace(c, java(pattern, ignore_case), replacement)


def ascii_digits(c: Column) -> Column:
    return F.translate(c, _DIGITS, _DIGIT_VALUES)


def to_int(c: Column) -> Column:
    """Whole number from a digit string of any script; NULL when out of BIGINT range."""
    whole = F.regexp_extract(c, r"^[+-]?\p{Nd}+(?:_\p{Nd}+)*+\z", 0)
    return ascii_digits(F.replace(whole, F.lit("_"), F.lit(""))).try_cast("bigint")


def extract_number(c: Column) -> Column:
    """First number once commas are gone, as DOUBLE."""
    return ascii_digits(truthy(F.regexp_extract(F.replace(c, F.lit(","), F.lit("")), r"\p{Nd}+\.?\p{Nd}*", 0))).try_cast("double")


# Date shapes in order of preference (shape test, then Spark datetime pattern).
DATE_SHAPES = [
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"),
    (r"^[A-Za-z]+ \d{1,2}, \d{4}$", "MMMM d, yyyy"),
    (r"^[A-Za-z]+ \d{1,2}, \d{4}$", "MMM d, yyyy"),
    (r"^\d{4}$", "yyyy"),
]


def parse_date(c: Column) -> Column:
    """ISO date by the first shape that parses, otherwise the cleaned input unchanged."""
    # Month names parse case-insensitively, so they are brought to title case first.
    read = lambda d, shape, fmt: F.date_format(F.try_to_timestamp(F.when(d.rlike(shape), F.initcap(d)), F.lit(fmt)), "yyyy-MM-dd")
    return let(clean_text(c), lambda d: F.coalesce(*[read(d, shape, fmt) for shape, fmt in DATE_SHAPES], d))


def normalize_list(items: Column) -> Column:
    """Cleaned members, blanks dropped; NULL list becomes empty."""
    cleaned = F.filter(F.transform(items, clean_text), lambda x: x.isNotNull())
    return F.coalesce(cleaned, F.array().cast("array<string>"))


def split_list(c: Column, delimiters: str = "[,;|]") -> Column:
    return normalize_list(F.split(c, delimiters))


def split_credits(c: Column) -> Column:
    return split_list(c, "[,&]")


def ist_timestamp(ts: Column) -> Column:
    """ISO-8601 text with microseconds in India Standard Time, whatever the session zone is."""
    micros = F.unix_micros(ts.cast("timestamp"))
    local = F.timestamp_micros(micros + F.lit(19_800_000_000))
    # Formatting goes through UTC arithmetic on the instant, so shift back the session zone's own offset.
    text = F.date_format(F.convert_timezone(F.current_timezone(), F.lit("UTC"), local.cast("timestamp_ntz")),
                         "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.concat(F.regexp_replace(text, r"\.000000$", ""), F.lit("+05:30"))


def name_key(c: Column) -> Column:
    return F.coalesce(F.upper(F.replace(c, F.lit(" "), F.lit("_"))), F.lit(""))


def title_words(c: Column) -> Column:
    """'a_b' -> 'A B'."""
    return F.initcap(F.replace(c, F.lit("_"), F.lit(" ")))


def folder_name(c: Column) -> Column:
    return F.replace(title_words(c), F.lit(" "), F.lit(""))


def display_name(c: Column, names: dict[str, str]) -> Column:
    """Known display name of a source, otherwise its parts capitalised."""
    known = [F.when(c == key, F.lit(value)) for key, value in names.items()]
    return F.coalesce(*known, title_words(c))


def run_file_name(ts: Column) -> Column:
    return F.concat(F.date_format(ts, "yyyy-MM-dd-hh-mm-ss-SSS-"), F.upper(F.date_format(ts, "a")), F.lit(".json"))


def slug_person(url: Column) -> Column:
    """'…-by-first-last' in the last path segment, as 'First Last'."""
    parts = F.split(url, "/")
    slug = F.try_element_at(parts, F.when(url.endswith("/"), F.lit(-2)).otherwise(F.lit(-1)))
    return F.initcap(F.replace(search(slug, r"-by-([a-z]+(?:-[a-z]+)++)", True), F.lit("-"), F.lit(" ")))


def contains_any(c: Column, needles: list[str]) -> Column:
    """True when any needle is a substring; false for NULL."""
    return F.coalesce(c.rlike("|".join(re.escape(n) for n in needles)), F.lit(False))


def first_label(c: Column, rules: list[tuple[list[str], str]]) -> Column:
    """Label of the first rule one of whose substrings occurs."""
    return F.coalesce(*[F.when(contains_any(c, needles), F.lit(label)) for needles, label in rules])


def first_match_label(c: Column, rules: list[tuple[str, str]]) -> Column:
    """Label of the first rule whose regex is found, ignoring case."""
    return F.coalesce(*[F.when(found(c, pattern, True), F.lit(label)) for pattern, label in rules])


# Language words and the names they stand for.
LANGUAGE_WORDS = {"hindi": "Hindi", "hin": "Hindi", "हिंदी": "Hindi", "english": "English", "eng": "English"}


def language_of(c: Column) -> Column:
    """Hindi or English by the first whole word that names one."""
    names = F.create_map(*[F.lit(x) for kv in LANGUAGE_WORDS.items() for x in kv])
    return F.try_element_at(names, F.lower(search(c, r"\b(Hindi|English|हिंदी|Eng|Hin)\b", True)))


def as_json(c: Column) -> Column:
    return F.to_json(c)


def words(c: Column) -> Column:
    """Split on runs of whitespace, as Python's bare ``split`` does; no empty members."""
    return F.filter(F.split(c, f"(?U)[{SPACE}]+"), lambda w: w != "")


def url_host(c: Column) -> Column:
    return search(c, r"https?://([^/]+)")


def in_domains(url: Column, domains: list[str]) -> Column:
    """Host equals one of the domains or lies under it."""
    host = F.lower(F.regexp_replace(F.regexp_replace(url_host(url), r"^.*@", ""), r":\d+$", ""))
    return F.coalesce(host.rlike(r"(^|\.)(" + "|".join(re.escape(d) for d in domains) + r")\z"), F.lit(False))
