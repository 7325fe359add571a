"""Column functions on texts, URLs, numbers in texts and addresses.

Python's ``\\s`` and ``\\d`` are Unicode; patterns here use explicit classes so that other engines agree.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Query keys that identify a click and not a page.
TRACKING_KEYS = ("referrer", "ref", "icmp")
TRACKING_PREFIX = "utm_"
CHALLENGE = "ich bin kein roboter"
BOILERPLATE = "Die vollständige Adresse"
REDIRECT_MARKS = ("clickout", "> quelle :")
KEYWORDS = {
    "student": ["student", "uni", "campus", "wg", "azubi", "ausbildung"],
    "family_with_kids": ["familie", "familienfreund", "kinder", "kita", "kindergarten", "schule", "spielplatz", "garten"],
    "senior": ["senior", "barrierefrei", "rollstuhl", "aufzug", "lift", "ebenerdig", "altersgerecht"],
    "remote_worker": ["homeoffice", "home office", "arbeitszimmer", "office", "schreibtisch", "glasfaser"],
    "car_commuter": ["garage", "stellplatz", "carport", "parkplatz", "tiefgarage"],
    "luxury": ["luxus", "exklusiv", "premium", "penthouse", "high-end", "neubau", "designer"],
}

_BLANK = "[ \\t-\\r\\u00A0]+"
# Fixed value: the numbers that a text can hold, grouped or plain.
_TOKEN = r"[-+]?\d{1,3}(?:[.\s]\d{3})+(?:[.,]\d+)?|[-+]?\d+(?:[.,]\d+)?"


def _none_if_empty(c: Column) -> Column:
    return F.when(c != "", c)


def _found(c: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match, null where there is none."""
    return _none_if_empty(F.regexp_extract(c, pattern, group))


def clean(c: Column) -> Column:
    """White space runs become one blank; blank texts become null."""
    return _none_if_empty(F.trim(F.regexp_replace(c, _BLANK, " ")))


def ascii_letters(c: Column) -> Column:
    """Latin letters without their marks; letters without an ASCII base go.

    Covers the precomposed Latin letters of western European languages by table; ``slugify_any`` takes the rest.
    """
    marked = "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝàáâãäåçèéêëìíîïñòóôõöùúûüýÿŠšŽž"
    plain = "AAAAAACEEEEIIIINOOOOOUUUUYaaaaaaceeeeiiiinooooouuuuyySsZz"
    return F.regexp_replace(F.translate(c, marked, plain), "[^\\x00-\\x7F]", "")


def _underscored(c: Column) -> Column:
    return F.lower(F.regexp_replace(F.regexp_replace(ascii_letters(c), "[^a-zA-Z0-9]+", "_"), "^_+|_+$", ""))


def slugify(c: Column) -> Column:
    """ASCII slug with underscores, ``field`` where nothing is left."""
    return F.when(c.isNotNull(), F.coalesce(_none_if_empty(_underscored(c)), F.lit("field")))


def sanitize_run_id(c: Column) -> Column:
    """Run id of lower-case ASCII letters, digits and single underscores; empty for null and blank ones."""
    return _underscored(F.trim(F.coalesce(c, F.lit(""))))


def chunk_prefix(file_name: Column) -> Column:
    """What stands before the four-digit number of a chunk file, without trailing underscores; null for other names."""
    return _none_if_empty(F.regexp_replace(F.regexp_extract(file_name, r"^(.+)\d{4}\.jsonl?$", 1), "_+$", ""))


def chunk_index(file_name: Column) -> Column:
    """The four-digit number of a chunk file, null for other names."""
    return _found(file_name, r"^.+(\d{4})\.jsonl?$")


def run_of_prefix(prefix: Column, constant: str = "expose_analysis") -> Column:
    """Run id of a chunk prefix without its constant part; null where nothing else is left."""
    rest = F.regexp_replace(prefix, f"^{constant}_", "")
    return F.when(prefix != constant, _none_if_empty(sanitize_run_id(rest)))


def slugify_any(c: Column) -> Column:
    """Like ``slugify`` for every script, by Unicode decomposition in Arrow batches."""
    @F.pandas_udf(T.StringType())
    def decomposed(s: pd.Series) -> pd.Series:
        return s.str.normalize("NFKD").str.encode("ascii", "ignore").str.decode("ascii")

    return slugify(decomposed(c))


def slugify_city(c: Column) -> Column:
    out = F.lower(F.trim(c))
    for letter, pair in (("ß", "ss"), ("ä", "ae"), ("ö", "oe"), ("ü", "ue")):
        out = F.replace(out, F.lit(letter), F.lit(pair))
    return F.regexp_replace(F.regexp_replace(out, "[^a-z0-9]+", "-"), "^-+|-+$", "")


def _decoded(c: Column) -> Column:
    return F.coalesce(F.try_url_decode(c), c)


def _encoded(c: Column) -> Column:
    """Percent-encoding of forms: blanks are ``+``; letters, digits and ``_.-~`` stay."""
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def canonical_url(c: Column) -> Column:
    """Drop tracking keys from the query; other pairs keep order, repeats and blank values, in one form of encoding."""
    base = F.regexp_extract(c, r"^([^?#]*)", 1)
    query = F.regexp_extract(c, r"^[^?#]*\?([^#]*)", 1)
    fragment = F.regexp_extract(c, r"(#.*)$", 1)
    pairs = F.transform(F.filter(F.split(query, "&"), lambda p: p != ""), lambda p: F.struct(_decoded(F.split_part(p, F.lit("="), F.lit(1))).alias("k"), F.when(F.instr(p, "=") > 0, _decoded(F.substr(p, F.instr(p, "=") + 1))).otherwise("").alias("v")))
    kept = F.filter(pairs, lambda p: ~p.k.isin(*TRACKING_KEYS) & ~p.k.startswith(TRACKING_PREFIX))
    joined = F.array_join(F.transform(kept, lambda p: F.concat(_encoded(p.k), F.lit("="), _encoded(p.v))), "&")
    return F.concat(base, F.when(joined != "", F.concat(F.lit("?"), joined)).otherwise(""), fragment)


def query_value(c: Column, key: str) -> Column:
    """The last value of a query key, null without it."""
    query = F.regexp_extract(c, r"^[^?#]*\?([^#]*)", 1)
    own = F.filter(F.split(query, "&"), lambda p: p.startswith(key + "="))
    return F.substr(F.element_at(F.when(F.size(own) > 0, own), -1), F.lit(len(key) + 2))


def url_path(c: Column) -> Column:
    return F.regexp_extract(c, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def expose_id(c: Column) -> Column:
    """Digits after ``/expose/`` in the path, else a numeric id in the query."""
    values = [query_value(c, k) for k in ("exposeId", "exposeid", "expose_id")]
    return F.coalesce(_found(url_path(c), r"/expose/(\d+)"), *[F.when(v.rlike(r"^\d+$"), v) for v in values])


def trailing_id(c: Column) -> Column:
    """The last dash-separated part of the path, if it is digits."""
    return _found(url_path(c), r"(?:^|[-/])(\d+)/?$")


def listing_id(c: Column) -> Column:
    """The last part of the path if it is digits, which ``im`` may lead."""
    return _found(url_path(c), r"/((?:im)?\d+)/?$")


def trailing_slug(c: Column) -> Column:
    """The first part of the path, ``unknown`` without one."""
    return F.coalesce(_found(url_path(c), r"^/?([^/]+)"), F.lit("unknown"))


def is_digits(c: Column) -> Column:
    return F.coalesce(c.rlike("^[0-9]+$"), F.lit(False))


def _without_dots(path: Column) -> Column:
    """An absolute path without its ``.`` and ``..`` segments."""
    parts = F.split(path, "/")
    empty = F.expr("cast(array() as array<string>)")
    walked = F.aggregate(F.slice(parts, 2, F.size(parts)), empty, lambda acc, p: F.when(p == ".", acc).when(p == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.concat(acc, F.array(p))))
    folder = F.element_at(parts, -1).isin(".", "..")
    return F.when(F.instr(path, "/.") > 0, F.concat(F.lit("/"), F.array_join(walked, "/"), F.when(folder & (F.size(walked) > 0), "/").otherwise(""))).otherwise(path)


def resolve_url(base: Column, href: Column) -> Column:
    """Absolute form of ``href`` on a page: scheme, ``//``, ``/``, ``?``, ``#`` and relative forms, dot segments resolved."""
    scheme = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1)
    root = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    page = F.regexp_extract(base, r"^([^?#]*)", 1)
    folder = F.coalesce(_found(url_path(base), r"^(.*/)"), F.lit("/"))
    own, rest = F.regexp_extract(href, r"^([^?#]*)", 1), F.regexp_extract(href, r"^[^?#]*(.*)$", 1)
    return (
        F.when(href.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("/"), F.concat(root, _without_dots(own), rest))
        .when(href.startswith("?"), F.concat(page, href))
        .when(href.startswith("#"), F.concat(F.regexp_extract(base, r"^([^#]*)", 1), href))
        .when(href == "", base)
        .otherwise(F.concat(root, _without_dots(F.concat(folder, own)), rest))
    )


def nested(value: Column, *keys: str, kind: str = "string") -> Column:
    """Value below a chain of keys of a VARIANT, null where any of them is missing or no object."""
    return F.try_variant_get(value, "$" + "".join(f"['{k}']" for k in keys), kind)


def contains_any(c: Column, needles: Sequence[str]) -> Column:
    """Whether the text contains any needle, whatever the case; no needles match all."""
    low = F.lower(c)
    hit = F.lit(not needles)
    for n in needles:
        hit = hit | low.contains(n.lower())
    return F.coalesce(hit, F.lit(False))


def is_redirect_page(html: Column) -> Column:
    low = F.lower(F.coalesce(html, F.lit("")))
    return low.contains(REDIRECT_MARKS[0]) | low.contains(REDIRECT_MARKS[1])


def is_error_body(html: Column) -> Column:
    return html.isNull() | html.startswith("ERROR")


def is_challenge(title: Column, heading: Column) -> Column:
    same = lambda c: F.coalesce(F.lower(clean(c)) == CHALLENGE, F.lit(False))
    return same(title) | same(heading)


def number_token(c: Column) -> Column:
    """A full date, else the first number that no letter touches; touched numbers are skipped whole."""
    text = F.regexp_replace(c, "\\u00A0", " ")
    date = _found(text, r"\b(\d{1,2}\.\d{1,2}\.\d{2,4})\b")
    marked = F.regexp_replace(text, f"({_TOKEN})", "\u0001$1\u0002")
    free = _found(marked, "(?<!\\p{L})\u0001([^\u0002]*)\u0002(?!\\p{L})")
    return F.coalesce(date, free)


def parse_number(c: Column, *, multi_group: bool = False) -> Column:
    """Number of a token with German or English separators; several dots without a comma give null.

    ``multi_group`` reads ``1.250.000`` as grouped thousands instead.
    """
    s = F.regexp_replace(F.trim(c), "[ \\u00A0]", "")
    dots = F.length(s) - F.length(F.replace(s, F.lit("."), F.lit("")))
    comma, dot = F.instr(s, ",") > 0, dots > 0
    last = lambda ch: F.length(s) - F.instr(F.reverse(s), ch)
    no_dots, no_commas = F.replace(s, F.lit("."), F.lit("")), F.replace(s, F.lit(","), F.lit(""))
    grouped = s.rlike(r"^-?\d{1,3}(\.\d{3})+$")
    plain = (
        F.when((dots > 1) & ~comma, F.when(grouped, no_dots) if multi_group else F.lit(None).cast("string"))
        .when(comma & dot, F.when(last(",") > last("."), F.replace(no_dots, F.lit(","), F.lit("."))).otherwise(no_commas))
        .when(comma, F.replace(s, F.lit(","), F.lit(".")))
        .when(dot & grouped, no_dots)
        .otherwise(s)
    )
    return plain.try_cast("double")


def as_float(c: Column) -> Column:
    """Amount in a text: unit marks go, ``1.234,56`` is German, ``1.234`` stays 1.234; only finite values."""
    s = F.regexp_replace(F.trim(c), "€|EUR|m²|qm|[ \\u00A0]", "")
    commas = F.length(s) - F.length(F.replace(s, F.lit(","), F.lit("")))
    dots = F.length(s) - F.length(F.replace(s, F.lit("."), F.lit("")))
    german = F.when((commas == 1) & (dots >= 1), F.replace(F.replace(s, F.lit("."), F.lit("")), F.lit(","), F.lit("."))).when(commas == 1, F.replace(s, F.lit(","), F.lit("."))).otherwise(s)
    return finite(F.regexp_replace(german, "[^0-9.+-]", "").try_cast("double"))


def finite(c: Column) -> Column:
    return F.when(~F.isnan(c) & (F.abs(c) < float("inf")), c)


def max_speed(c: Column, *, any_length: bool = False) -> Column:
    """First number of a speed tag: up to three digits, or any with ``any_length``."""
    return _found(F.lower(c), r"(\d+)" if any_length else r"(\d{1,3})").try_cast("int")


def gtfs_seconds(c: Column) -> Column:
    """Seconds of ``H:MM[:SS]``; hours may pass 24, minutes and seconds stay below 60, else null."""
    part = lambda g: F.regexp_extract(F.trim(c), r"^(\d+):(\d{2})(?::(\d{2}))?$", g).try_cast("int")
    h, m, s = part(1), part(2), F.coalesce(part(3), F.lit(0))
    return F.when((m < 60) & (s < 60), h * 3600 + m * 60 + s)


def parse_address(c: Column) -> Column:
    """Struct ``raw, cleaned, district, street, housenumber, postcode, city``."""
    cleaned = F.trim(F.regexp_replace(F.regexp_replace(F.trim(c), f"(?i)\\b{BOILERPLATE}.*$", ""), "[ \\t-\\r]+", " "))
    postcode = _found(cleaned, r"\b(\d{5})\b")
    trimmed = lambda x: F.regexp_replace(x, "^[ ,]+|[ ,]+$", "")
    at = F.call_function("locate", postcode, cleaned)
    after = trimmed(cleaned.substr(at + 5, F.length(cleaned)))
    before = F.when(postcode.isNull(), cleaned).otherwise(trimmed(cleaned.substr(F.lit(1), at - 1)))
    first = lambda x: F.trim(F.split_part(x, F.lit(","), F.lit(1)))
    left = first(before)
    numbered = left.rlike(r"\d")
    pattern = r"^(.+?) +(\d+[a-zA-Z]?)$"
    street = F.when(numbered, F.coalesce(F.trim(_found(left, pattern, 1)), left))
    return F.struct(
        c.alias("raw"),
        cleaned.alias("cleaned"),
        F.when(~numbered, _none_if_empty(left)).alias("district"),
        street.alias("street"),
        F.when(numbered, _found(left, pattern, 2)).alias("housenumber"),
        postcode.alias("postcode"),
        F.when(postcode.isNotNull(), _none_if_empty(first(after))).alias("city"),
    )


def city_from_address(c: Column) -> Column:
    """Text after the first five-digit code up to a comma, without the boilerplate."""
    rest = F.regexp_replace(F.regexp_extract(F.trim(c), r"\b\d{5}\b(.*)$", 1), "^[ ,]+|[ ,]+$", "")
    return _none_if_empty(F.trim(F.split_part(F.trim(F.split_part(rest, F.lit(","), F.lit(1))), F.lit(f" {BOILERPLATE[:15]}"), F.lit(1))))


def keyword_score(c: Column, words: Sequence[str]) -> Column:
    """Share of keywords contained, full at five of them (or all, if there are fewer)."""
    low = F.lower(F.coalesce(c, F.lit("")))
    hits = F.lit(0)
    for w in words:
        hits = hits + low.contains(w).cast("int")
    return F.least(F.lit(1.0), hits / float(max(1, min(5, len(words)))))


def listing_text(*parts: Column) -> Column:
    """Parts joined by blanks, null parts as empty texts."""
    return F.concat_ws(" ", *[F.coalesce(p, F.lit("")) for p in parts])


def lit_state(c: Column) -> Column:
    low = F.lower(F.trim(c))
    return F.when(low.isin("yes", "true", "1"), "yes").when(low.isin("no", "false", "0"), "no").otherwise("other")


def short_sha1(c: Column) -> Column:
    return F.substring(F.sha1(F.encode(c, "utf-8")), 1, 12)


def done_key(url: Column, sha: Column) -> Column:
    return F.concat_ws("|", url, sha)


def hash_fraction(key: Column, seed: int | str) -> Column:
    """A number in [0, 1] from the first two bytes of sha256(seed:key)."""
    return F.conv(F.substring(F.sha2(F.encode(F.concat_ws(":", F.lit(str(seed)), key), "utf-8"), 256), 1, 4), 16, 10).cast("double") / 65535.0


def split_name(key: Column, seed: int | str, train: float = 0.8, validation: float = 0.1) -> Column:
    u = hash_fraction(key, seed)
    return F.when(u < train, "train").when(u < train + validation, "val").otherwise("test")


def suggested_type(types: Column) -> Column:
    """Database type for a set of JSON type names."""
    has = lambda *names: F.arrays_overlap(types, F.array(*[F.lit(n) for n in names]))
    return F.when(has("dict", "list"), "json").when(has("bool") & ~has("int", "float", "str"), "boolean").when(has("int", "float") & ~has("str"), "numeric").when(has("str"), "text").otherwise("unknown")


def price_buckets(low: int, step: int, high: int) -> list[tuple[int | None, int | None]]:
    """Half-open price ranges with open ends."""
    cuts = list(range(low, high + 1, step))
    return list(zip([None, *cuts], [*cuts, None]))
