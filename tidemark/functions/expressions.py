"""Column functions of the domain; each is a plain Catalyst expression."""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.config import BOILERPLATE_PHRASES, DEFAULT_INTERVAL, FINANCIAL_THEMES, FUSION_WINDOWS, LEGAL_FORM, MARKET_CLOSE_HOUR_UTC, MARKET_CLOSE_MINUTE, MARKET_OPEN_MINUTE, NAME_SUFFIXES, ORG_SPAN, TONE_THRESHOLD

DAY_MS = 86_400_000


def strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


# ---- time ----


def parse_published(text: Column) -> Column:
    """ISO time with ``Z``, an offset, or none (then UTC) as epoch milliseconds; null where it can't be read."""
    return F.unix_millis(F.try_to_timestamp(text))


def parse_compact_time(text: Column) -> Column:
    """``yyyyMMddHHmmss`` in UTC as epoch milliseconds; null where it can't be read."""
    return F.when(text.rlike(r"^\d{14}$"), F.unix_millis(F.try_to_timestamp(text, F.lit("yyyyMMddHHmmss"))))


def reference_ms(interval: Column, timestamp_ms: Column) -> Column:
    """The moment a bar stands for: market close for daily bars, else its own time."""
    day = F.floor(timestamp_ms / DAY_MS).cast("long") * DAY_MS
    return F.when(interval == "1d", day + MARKET_CLOSE_HOUR_UTC * 3_600_000).otherwise(timestamp_ms)


def window_minutes(interval: Column, side: int) -> Column:
    """Minutes that a bar looks back (side 0) or ahead (side 1); an unknown interval is taken as daily."""
    out = F.lit(FUSION_WINDOWS[DEFAULT_INTERVAL][side])
    for name, both in FUSION_WINDOWS.items():
        out = F.when(interval == name, F.lit(both[side])).otherwise(out)
    return out


def in_market_hours(ms: Column) -> Column:
    """Monday to Friday, 13:30 to 20:00 UTC by the minute."""
    days, minute = F.floor(ms / DAY_MS), F.floor(F.pmod(ms, F.lit(DAY_MS)) / 60_000)
    return (F.pmod(days + 3, F.lit(7)) < 5) & minute.between(MARKET_OPEN_MINUTE, MARKET_CLOSE_MINUTE)


# ---- text ----


def strip_boilerplate(text: Column) -> Column:
    """Trimmed paragraphs that are neither blank nor hold a boilerplate phrase, in any case. Paragraphs are looked at one by one only in texts with a phrase."""
    whole = F.coalesce(text, F.lit(""))
    phrases = "(?i)" + "|".join(re.escape(p).replace("\\ ", " ") for p in BOILERPLATE_PHRASES)
    # a variable of one value, as Spark would put the text in lower case again for each phrase
    found = F.exists(F.array(F.lower(whole)), lambda low: reduce(or_, [low.contains(p.lower()) for p in BOILERPLATE_PHRASES]))
    lines = F.filter(F.transform(F.split(whole, "\n"), lambda p: F.btrim(p, F.lit(" \t\n\x0b\f\r"))), lambda p: p != "")
    return F.array_join(F.when(found, F.filter(lines, lambda p: ~p.rlike(phrases))).otherwise(lines), "\n")


def extract_orgs(text: Column) -> Column:
    """Distinct organisation names of a text in alphabetical order: spans of capitalised words without legal form."""
    spans = F.transform(F.regexp_extract_all(text, F.lit(f"({ORG_SPAN})"), 1), lambda s: F.trim(F.regexp_replace(s, LEGAL_FORM, "")))
    return F.array_sort(F.array_distinct(F.filter(spans, lambda s: F.length(s) >= 2)))


def strip_name_suffix(name: Column) -> Column:
    """A lower-case name without the first suffix of the list that it ends with, and without outer blanks, dots and commas."""
    out = name
    for s in reversed(NAME_SUFFIXES):
        out = F.when(name.endswith(s), F.substring(name, F.lit(1), F.length(name) - len(s))).otherwise(out)
    return F.regexp_replace(out, r"^[ .,]+|[ .,]+$", "")


def page_of_url(url: Column) -> Column:
    """What two links to one page have in common: host in lower case without ``www.``, and path without its last slash; no scheme, query or fragment."""
    rest = F.regexp_replace(F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://", ""), r"[?#].*$", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(rest, r"^[^/]*", 0)), r"^www\.", "")
    return F.nullif(F.regexp_replace(F.concat(host, F.regexp_extract(rest, r"/.*$", 0)), "/+$", ""), F.lit(""))


# ---- open-data records ----


def financial_themes(field: Column) -> Column:
    return F.array_sort(F.array_intersect(F.array_distinct(F.split(field, ";")), strings(FINANCIAL_THEMES)))


def parse_tone(field: Column) -> Column:
    """Tone struct from comma-separated numbers; what follows the first number that can't be read is null."""
    parts = F.split(field, ",")

    def number(i: int) -> Column:
        return F.get(parts, F.lit(i)).try_cast("double")

    def bad(i: int) -> Column:
        p = F.get(parts, F.lit(i))
        return F.coalesce((p != "") & number(i).isNull(), F.lit(False))

    names, ok, fields = ["tone_score", "positive", "negative", "polarity", "activity_ref_density", None, "word_count"], F.lit(True), []
    for i, n in enumerate(names):
        if n:
            ok = ok & ~bad(i)
            fields.append(F.when(ok, number(i)).cast("int" if n == "word_count" else "double").alias(n))
    return F.struct(*fields)


# ---- labels ----


def vendor_label(pos: Column, neg: Column, neu: Column, present: Column) -> Column:
    """The largest of three shares, null as 0; ties go to positive, then negative. Null if the vendor gave none."""
    p, n, u = (F.coalesce(c, F.lit(0.0)) for c in (pos, neg, neu))
    return F.when(present, F.when((p >= n) & (p >= u), "positive").when(n >= u, "negative").otherwise("neutral"))


def tone_label(score: Column) -> Column:
    return F.when(score >= TONE_THRESHOLD, "positive").when(score <= -TONE_THRESHOLD, "negative").when(score.isNotNull(), "neutral")


def normal_label(label: Column, known_model: Column) -> Column:
    low = F.lower(label)
    return F.when(known_model, low).when(low.contains("pos"), "positive").when(low.contains("neg"), "negative").otherwise("neutral")


def agrees(a: Column, b: Column) -> Column:
    """Equality that is false, not null, where a label is missing."""
    return F.coalesce(a == b, F.lit(False))
