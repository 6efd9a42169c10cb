"""Text columns: cleaning, identifiers, keys, tokens and links.

Everything is built in but Unicode normalisation, case folding and entity
decoding, which Spark lacks; those are Arrow-batched.
"""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
#: Words that say nothing about a title's topic, and about an abstract's.
TITLE_STOP_WORDS = (
    "a an the of in on for to and or with without from by at as is are was were be been being study studies analysis analyses evaluation assessment "
    "effect effects impact association associations using based among between during after before through via towards toward new novel randomized "
    "randomised controlled trial trials systematic review meta umbrella scoping network cohort prospective retrospective longitudinal cross sectional "
    "case report series survey protocol dataset data benchmark resource validation external independent safety mortality adverse"
).split()
ABSTRACT_STOP_WORDS = "a an the of in on for to and or with from by study analysis effect impact association using based results methods randomized trial review meta cohort prospective retrospective validation safety data".split()


@F.pandas_udf(T.StringType())
def unescape_entities(s: pd.Series) -> pd.Series:
    return s.map(html.unescape, na_action="ignore")


@F.pandas_udf(T.StringType())
def _folded(s: pd.Series) -> pd.Series:
    """NFKC, then case folding."""
    return s.map(lambda v: unicodedata.normalize("NFKC", v).casefold(), na_action="ignore")


def folded_nfkc(c: Column) -> Column:
    """NFKC, then case folding, and nothing else."""
    return _folded(c)


@F.pandas_udf(T.StringType())
def _split_folded(s: pd.Series) -> pd.Series:
    """NFKD, then case folding; marks stay as characters of their own."""
    return s.map(lambda v: unicodedata.normalize("NFKD", v).casefold(), na_action="ignore")


@F.pandas_udf(T.StringType())
def _ascii(s: pd.Series) -> pd.Series:
    return s.map(lambda v: unicodedata.normalize("NFKD", v).encode("ascii", "ignore").decode(), na_action="ignore")


@F.pandas_udf(T.StringType())
def idna_host(s: pd.Series) -> pd.Series:
    def one(host: str) -> str | None:
        try:
            return host.encode("idna").decode("ascii").casefold()
        except UnicodeError:
            return None

    return s.map(one, na_action="ignore")


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def filled(c: Column, default: str) -> Column:
    """``c``, or a default where it is null or empty."""
    return F.coalesce(blank_to_null(c), F.lit(default))


def strip_tags(c: Column) -> Column:
    """Tags become spaces, spaces collapse, ends are trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), "<[^>]+>", " "), r"(?U)\s+", " "))


def clean_text(c: Column) -> Column:
    """Entities are decoded first, so an escaped ``<`` can open a tag."""
    return strip_tags(unescape_entities(F.coalesce(c, F.lit(""))))


def normalize_doi(c: Column, clean=clean_text) -> Column:
    raw = F.regexp_replace(clean(c), r"(?i)^(?:https?://(?:dx\.)?doi\.org/|doi:\s*)", "")
    return blank_to_null(F.lower(F.regexp_replace(F.trim(raw), r"[.,;)]+$", "")))


def normalize_issn(c: Column) -> Column:
    compact = F.upper(F.regexp_replace(c, "[^0-9Xx]", ""))
    return F.when(F.length(compact) == 8, F.concat_ws("-", F.substring(compact, 1, 4), F.substring(compact, 5, 4)))


def normalize_name(c: Column, ascii_only: bool = False) -> Column:
    cleaned = strip_tags(c) if ascii_only else clean_text(c)
    return F.trim(F.regexp_replace(F.lower(cleaned) if ascii_only else _folded(cleaned), r"(?U)\s+", " "))


def normalize_title_key(c: Column, ascii_only: bool = False) -> Column:
    """Only a-z and 0-9 of a title, marks dropped from their letters. ``ascii_only`` keeps to built-in functions."""
    if ascii_only:  # spaces go in any case, so they needn't collapse first
        folded = F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), "<[^>]+>", " "))
    else:
        folded = _split_folded(clean_text(c))
    return F.regexp_replace(folded, "[^a-z0-9]+", "")


def slugify(c: Column) -> Column:
    return filled(F.lower(F.regexp_replace(F.regexp_replace(_ascii(c), "[^A-Za-z0-9]+", "-"), "^-+|-+$", "")), "edition")


def contains_cjk(c: Column) -> Column:
    return F.coalesce(c.rlike(r"[㐀-䶿一-鿿豈-﫿]"), F.lit(False))


def title_tokens(c: Column, stop: list[str] | None = None, least: int = 3, ascii_only: bool = False) -> Column:
    """Tokens of ``least`` letters or more that aren't stop words, in order and with repeats."""
    text = F.lower(F.coalesce(c, F.lit(""))) if ascii_only else _split_folded(F.coalesce(c, F.lit("")))
    skip = F.array(*map(F.lit, TITLE_STOP_WORDS if stop is None else stop))
    return F.filter(F.regexp_extract_all(text, F.lit("[A-Za-z0-9]+"), F.lit(0)), lambda t: (F.length(t) >= least) & ~F.array_contains(skip, t))


def topic_signature(tokens: Column, size: int = 4) -> Column:
    return filled(F.array_join(F.slice(F.array_distinct(tokens), 1, size), "|"), "untitled")


def jaccard(a: Column, b: Column) -> Column:
    """Of two token arrays as sets; zero if either is empty."""
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))).otherwise(F.lit(0.0))


def sha256_text(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def digest_json(**columns: Column) -> Column:
    """sha256 of a row as JSON with sorted keys and nulls kept."""
    return F.sha2(F.to_json(F.struct(*(columns[k].alias(k) for k in sorted(columns))), {"ignoreNullFields": "false"}), 256)


def parse_loose_date(c: Column, clean=clean_text) -> Column:
    """Struct (date, precision) of a date written in one of the ways that sources use; null fields where there is none."""
    raw = clean(c)
    numbers = F.create_map(*(x for i, m in enumerate(MONTHS, 1) for k in dict.fromkeys((m[:3], m)) for x in (F.lit(k), F.lit(f"{i:02d}"))))
    day = lambda *parts: F.try_to_timestamp(F.concat_ws("-", *parts), F.lit("yyyy-MM-dd")).cast("date")
    month = lambda name: F.try_element_at(numbers, F.lower(name))
    first = F.lit("01")
    spelled = r"^(\d{4})\s+([A-Za-z]+)(?:\s+(\d{1,2}))?$"
    year, name, d = (F.regexp_extract(raw, spelled, i) for i in (1, 2, 3))
    any_year = r"(?U)\b((?:19|20)\d{2})(?:\s+([A-Za-z]{3,9}))?\b"
    y2, n2 = (F.regexp_extract(raw, any_year, i) for i in (1, 2))
    named = raw.rlike(spelled) & month(name).isNotNull()
    made = (
        F.when(raw.rlike(r"^\d{4}-\d{2}-\d{2}(?:[T ].*)?$"), F.struct(day(F.substring(raw, 1, 10)).alias("date"), F.lit("DAY").alias("precision")))
        .when(raw.rlike(r"^\d{4}-\d{2}$"), F.struct(day(raw, first).alias("date"), F.lit("MONTH").alias("precision")))
        .when(raw.rlike(r"^\d{4}$"), F.struct(day(raw, first, first).alias("date"), F.lit("YEAR").alias("precision")))
        .when(named & (d != ""), F.struct(day(year, month(name), F.lpad(d, 2, "0")).alias("date"), F.lit("DAY").alias("precision")))
        .when(named, F.struct(day(year, month(name), first).alias("date"), F.lit("MONTH").alias("precision")))
        .when((y2 != "") & month(n2).isNotNull(), F.struct(day(y2, month(n2), first).alias("date"), F.lit("MONTH").alias("precision")))
        .when(y2 != "", F.struct(day(y2, first, first).alias("date"), F.lit("YEAR").alias("precision")))
    )
    return F.when(made["date"].isNotNull(), made)


def date_from_parts(year: Column, month: Column, day: Column) -> Column:
    """Struct (date, precision) of the parts that are given; null where they make no date."""
    text = F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(F.coalesce(month, F.lit(1)).cast("string"), 2, "0"), F.lpad(F.coalesce(F.when(month.isNotNull(), day), F.lit(1)).cast("string"), 2, "0"))
    date = F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).cast("date")
    precision = F.when(month.isNull(), "YEAR").when(day.isNull(), "MONTH").otherwise("DAY")
    return F.when(year.isNotNull() & date.isNotNull(), F.struct(date.alias("date"), precision.alias("precision")))


def safe_url(c: Column, idna: bool = True) -> Column:
    """An http(s) link without user data or fragment, its scheme and host in lower case; else null."""
    form = r"^\s*([A-Za-z][A-Za-z0-9+.-]*)://([^/?#\s]*)([^?#]*)(\?[^#]*)?(#.*)?$"
    scheme, place, path, query = (F.regexp_extract(c, form, i) for i in (1, 2, 3, 4))
    host, port = F.regexp_extract(place, r"^(\[[^\]]*\]|[^:]*)(?::(\d*))?$", 1), F.regexp_extract(place, r"^(\[[^\]]*\]|[^:]*)(?::(\d*))?$", 2)
    known = F.lower(host) if not idna else F.when(host.rlike(r"^[\x00-\x7f]*$"), F.lower(host)).otherwise(idna_host(host))
    number = F.coalesce(blank_to_null(port).try_cast("int"), F.lit(0))
    ok = F.lower(scheme).isin("http", "https") & (host != "") & ~place.contains("@") & (number <= 65535)
    said = F.concat(F.lower(scheme), F.lit("://"), known, F.when(port != "", F.concat(F.lit(":"), number.cast("string"))).otherwise(""), F.when(F.rtrim(path) == "", "/").otherwise(F.rtrim(path)), F.when(F.length(query) > 1, F.rtrim(query)).otherwise(""))
    return F.when(ok, said)


def publisher_url(c: Column, idna: bool = True) -> Column:
    """A publisher's safe link; a redirect of Elsevier's by PII becomes the article's own page."""
    link = safe_url(c, idna)
    pii = F.regexp_replace(F.regexp_extract(link, r"^https?://linkinghub\.elsevier\.com/retrieve/pii/([^?#]*)", 1), "^/+|/+$", "")
    return F.when(F.replace(pii, F.lit("-"), F.lit("")).rlike(r"^[A-Za-z0-9]+$"), F.concat(F.lit("https://www.sciencedirect.com/science/article/pii/"), pii)).otherwise(link)


def open_licence_host(c: Column, hosts: tuple[str, ...] = ("creativecommons.org",)) -> Column:
    """Whether a link's host is one of ``hosts`` or below one."""
    host = F.lower(F.regexp_extract(c, r"^\s*https?://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.coalesce(F.greatest(*((host == h) | host.endswith("." + h) for h in hosts), F.lit(False)), F.lit(False))


def display_date(date: Column, precision: Column) -> Column:
    text = F.date_format(date, "yyyy-MM-dd")
    return F.when(precision == "YEAR", F.substring(text, 1, 4)).when(precision == "MONTH", F.substring(text, 1, 7)).otherwise(text)


def first_letter(c: Column) -> Column:
    letter = F.upper(F.substring(F.ltrim(c), 1, 1))
    return F.when(letter.rlike("^[A-Z]$"), letter).otherwise("#")


def date_number(date: Column) -> Column:
    """yyyymmdd as a number; 0 without a date."""
    return F.coalesce(F.date_format(date, "yyyyMMdd").cast("int"), F.lit(0))


def bounded_int(c: Column, low: int, high: int) -> Column:
    """A whole number within bounds, or null."""
    n = c.cast("string").try_cast("int")
    return F.when(n.between(low, high), n)
