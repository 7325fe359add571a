"""Registered queries on texts, URLs, pages and numbers in texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import html, records
from ..operators.ranking import ranked
from ..sources.scratch import staged
from .base import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


@query("SELECT doc_id, md5(nullif(trim(regexp_replace(text, '[ \\t-\\r\\x{A0}]+', ' ', 'g')), '')) AS clean_md5, length(nullif(trim(regexp_replace(text, '[ \\t-\\r\\x{A0}]+', ' ', 'g')), '')) AS n FROM documents")
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = T.clean(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(F.encode(c, "utf-8")).alias("clean_md5"), F.length(c).cast("long").alias("n"))


_MARKED, _PLAIN = "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝàáâãäåçèéêëìíîïñòóôõöùúûüýÿŠšŽž", "AAAAAACEEEEIIIINOOOOOUUUUYaaaaaaceeeeiiiinooooouuuuyySsZz"


@query(f"SELECT doc_id, md5(coalesce(nullif(lower(trim(regexp_replace(regexp_replace(translate(text, '{_MARKED}', '{_PLAIN}'), '[^\\x00-\\x7F]', '', 'g'), '[^a-zA-Z0-9]+', '_', 'g'), '_')), ''), 'field')) AS slug_md5 FROM documents")
def slugify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(F.encode(T.slugify(F.col("text")), "utf-8")).alias("slug_md5"))


@query("SELECT doc_id, md5(coalesce(nullif(lower(trim(regexp_replace(regexp_replace(strip_accents(text), '[^\\x00-\\x7F]', '', 'g'), '[^a-zA-Z0-9]+', '_', 'g'), '_')), ''), 'field')) AS slug_md5 FROM documents")
def slugify_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(F.encode(T.slugify_any(F.col("text")), "utf-8")).alias("slug_md5"))


_CITY = "'  München-' || n_name || ' Süd/Größe ' || n_nationkey"


@query(f"SELECT n_nationkey, trim(regexp_replace(replace(replace(replace(replace(lower(trim({_CITY})), 'ß', 'ss'), 'ä', 'ae'), 'ö', 'oe'), 'ü', 'ue'), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM nation")
def slugify_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.lit("  München-"), "n_name", F.lit(" Süd/Größe "), F.col("n_nationkey").cast("string"))
    return table(spark, sf_dir, "nation").select("n_nationkey", T.slugify_city(name).alias("slug"))


_FULL_URL = "CASE WHEN contains(url, '?') THEN url || '&q=a%20b*~c+d&x=%C3%BC&utm_medium=z&e' ELSE url END"
_PAIRS = "list_transform(list_filter(string_split(regexp_extract(u, '^[^?#]*\\?([^#]*)', 1), '&'), lambda p: p <> ''), lambda p: {'k': url_decode(replace(split_part(p, '=', 1), '+', ' ')), 'v': CASE WHEN contains(p, '=') THEN url_decode(replace(substr(p, instr(p, '=') + 1), '+', ' ')) ELSE '' END})"
_KEPT = f"list_transform(list_filter({_PAIRS}, lambda p: p.k NOT IN ('referrer', 'ref', 'icmp') AND NOT starts_with(p.k, 'utm_')), lambda p: replace(url_encode(p.k), '%20', '+') || '=' || replace(url_encode(p.v), '%20', '+'))"


def canonical_sql(u: str) -> str:
    return f"(SELECT regexp_extract(u, '^([^?#]*)', 1) || CASE WHEN len({_KEPT}) > 0 THEN '?' || array_to_string({_KEPT}, '&') ELSE '' END || regexp_extract(u, '(#.*)$', 1) FROM (SELECT {u} AS u))"


@query(f"SELECT page_id, {canonical_sql(_FULL_URL)} AS canonical FROM pages")
def canonical_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.when(F.col("url").contains("?"), F.concat("url", F.lit("&q=a%20b*~c+d&x=%C3%BC&utm_medium=z&e"))).otherwise(F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", T.canonical_url(u).alias("canonical"))


_CHUNK = "CASE WHEN o_orderkey % 10 = 0 THEN 'failed.jsonl' ELSE 'expose_analysis_Run-' || (o_custkey % 7) || '__' || lpad((o_orderkey % 10000)::VARCHAR, 4, '0') || '.jsonl' END"


@query(f"WITH f AS (SELECT o_orderpriority, nullif(rtrim(regexp_extract({_CHUNK}, '^(.+)\\d{{4}}\\.jsonl?$', 1), '_'), '') AS p FROM orders), c AS (SELECT o_orderpriority, p, count(*) AS n FROM f WHERE p IS NOT NULL GROUP BY 1, 2) SELECT o_orderpriority, lower(trim(regexp_replace(replace(p, 'expose_analysis_', ''), '[^a-zA-Z0-9]+', '_', 'g'), '_')) AS run FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY n DESC, p) AS k FROM c) WHERE k = 1")
def run_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run of each group of chunk files, from their most common prefix."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    name = F.when(k % 10 == 0, "failed.jsonl").otherwise(F.concat(F.lit("expose_analysis_Run-"), (c % 7).cast("string"), F.lit("__"), F.lpad((k % 10000).cast("string"), 4, "0"), F.lit(".jsonl")))
    return records.infer_runs(table(spark, sf_dir, "orders").select("o_orderpriority", name.alias("file_name")), by=["o_orderpriority"])


_LURL = "'https://x.example' || CASE c_custkey % 4 WHEN 0 THEN '/stadt-' || c_nationkey || '/im' || c_custkey || '/' WHEN 1 THEN '/ort/' || c_custkey || '?a=1' WHEN 2 THEN '/ort/x' || c_custkey ELSE '' END"


@query(f"WITH u AS (SELECT c_custkey, regexp_extract(regexp_extract({_LURL}, '^https://[^/?#]*(.*)$', 1), '^[^?#]*', 0) AS p FROM customer), i AS (SELECT c_custkey, nullif(regexp_extract(p, '/((?:im)?\\d+)/?$', 1), '') AS listing_id, coalesce(nullif(regexp_extract(p, '^/?([^/]+)', 1), ''), 'unknown') AS slug FROM u) SELECT *, coalesce(regexp_full_match(listing_id, '[0-9]+'), false) AS digits FROM i")
def listing_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, s = F.col("c_custkey"), F.col("c_custkey").cast("string")
    path = F.when(c % 4 == 0, F.concat(F.lit("/stadt-"), F.col("c_nationkey").cast("string"), F.lit("/im"), s, F.lit("/"))).when(c % 4 == 1, F.concat(F.lit("/ort/"), s, F.lit("?a=1"))).when(c % 4 == 2, F.concat(F.lit("/ort/x"), s)).otherwise("")
    u = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("https://x.example"), path).alias("u"))
    ids = u.select("c_custkey", T.listing_id(F.col("u")).alias("listing_id"), T.trailing_slug(F.col("u")).alias("slug"))
    return ids.withColumn("digits", T.is_digits(F.col("listing_id")))


@query(f"WITH u AS (SELECT c_custkey, regexp_extract({_LURL}, '/([^/?#]*)/?(?:[?#].*)?$', 1) AS id FROM customer) SELECT c_custkey, id FROM u WHERE regexp_full_match(id, '[0-9]+')")
def digit_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the records whose id is all digits."""
    c, s = F.col("c_custkey"), F.col("c_custkey").cast("string")
    own = F.when(c % 4 == 0, F.concat(F.lit("im"), s)).when(c % 4 == 1, s).when(c % 4 == 2, F.concat(F.lit("x"), s)).otherwise("x.example")
    return records.numeric_ids(table(spark, sf_dir, "customer").select("c_custkey", own.alias("id")), "id")


_EXPOSE = "CASE page_id % 4 WHEN 0 THEN 'https://x.example/expose/' || page_id || '/a?q=1' WHEN 1 THEN url || '&exposeId=' || page_id WHEN 2 THEN 'https://x.example/s?expose_id=' || page_id || 'x' ELSE url END"


def _expose_url() -> Column:
    p, s = F.col("page_id"), F.col("page_id").cast("string")
    return F.when(p % 4 == 0, F.concat(F.lit("https://x.example/expose/"), s, F.lit("/a?q=1"))).when(p % 4 == 1, F.concat("url", F.lit("&exposeId="), s)).when(p % 4 == 2, F.concat(F.lit("https://x.example/s?expose_id="), s, F.lit("x"))).otherwise(F.col("url"))


@query(f"WITH u AS (SELECT page_id, {_EXPOSE} AS u FROM pages) SELECT page_id, coalesce(nullif(regexp_extract(regexp_extract(u, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1), '/expose/(\\d+)', 1), ''), nullif(regexp_extract(regexp_extract(u, '^[^?#]*\\?([^#]*)', 1), '(?:^|&)exposeId=(\\d+)(?:&|$)', 1), ''), nullif(regexp_extract(regexp_extract(u, '^[^?#]*\\?([^#]*)', 1), '(?:^|&)expose_id=(\\d+)(?:&|$)', 1), '')) AS expose_id, nullif(regexp_extract(regexp_extract(u, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1), '(?:^|[-/])(\\d+)/?$', 1), '') AS trailing_id FROM u")
def expose_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = table(spark, sf_dir, "pages").select("page_id", _expose_url().alias("u"))
    return u.select("page_id", T.expose_id(F.col("u")).alias("expose_id"), T.trailing_id(F.col("u")).alias("trailing_id"))


_HREFS = ["/a/b", "//h.example/x", "c.html", "?p=2", "#top", "https://y.example/z", "mailto:a@b.example", "", "/a/../b/.", "../up/./d?z=../1"]
_HREF = f"{_HREFS!r}[page_id % 10 + 1]"


@query(f"WITH u AS (SELECT page_id, url, {_HREF} AS h, regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1) AS root FROM pages), v AS (SELECT *, coalesce(nullif(regexp_extract(regexp_extract(url, '^[^?#]*', 0)[length(root) + 1:], '^(.*/)', 1), ''), '/') AS folder FROM u) SELECT page_id, CASE WHEN regexp_matches(h, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN h WHEN starts_with(h, '//') THEN regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*:)', 1) || h WHEN h = '/a/../b/.' THEN root || '/b/' WHEN starts_with(h, '../') THEN root || coalesce(nullif(regexp_replace(folder, '[^/]+/$', ''), ''), '/') || 'up/d?z=../1' WHEN starts_with(h, '/') THEN root || h WHEN starts_with(h, '?') THEN regexp_extract(url, '^([^?#]*)', 1) || h WHEN starts_with(h, '#') THEN regexp_extract(url, '^([^#]*)', 1) || h WHEN h = '' THEN url ELSE root || folder || h END AS resolved FROM v")
def url_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    href = F.element_at(F.array(*map(F.lit, _HREFS)), (F.col("page_id") % 10 + 1).cast("int"))
    return table(spark, sf_dir, "pages").select("page_id", T.resolve_url(F.col("url"), href).alias("resolved"))


@query("WITH a AS (SELECT page_id, url, unnest(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1)) AS h FROM pages), r AS (SELECT DISTINCT page_id, regexp_extract(regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1) || h, '^([^?#]*)', 1) AS link FROM a WHERE starts_with(h, '/') AND NOT starts_with(h, '//')) SELECT page_id, count(*) AS links, min(link) AS first_link, max(link) AS last_link FROM r GROUP BY 1")
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site links of pages: anchors that match, absolute, without query and fragment, distinct."""
    links = html.listing_links(table(spark, sf_dir, "pages").select("page_id", "url", "html"), keep="^/(?!/)")
    return links.groupBy("page_id").agg(F.count("*").alias("links"), F.min("link").alias("first_link"), F.max("link").alias("last_link"))


_UNESC = "replace(replace(replace(replace({0}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;', '&')"


@query(f"SELECT page_id, nullif(trim(regexp_replace({_UNESC.format(chr(34) + 't' + chr(34))}, '[ \\t-\\r]+', ' ', 'g')), '') AS title FROM (SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS t FROM pages)")
def page_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    walked = html.walk_pages(table(spark, sf_dir, "pages").select("page_id", "html"))
    return walked.select("page_id", T.clean(F.col("title")).alias("title"))


_PLAIN_TEXT = "nullif(trim(regexp_replace(" + _UNESC.format("{0}") + ", '[ \\t-\\r]+', ' ', 'g')), '')"


@query(f"WITH p AS (SELECT page_id, regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1) AS root, html, regexp_extract(html, '<h1>([^<]*)</h1>', 1) AS h, regexp_extract(html, '<title>([^<]*)</title>', 1) AS t, regexp_extract(html, '<div class=\"ad\">([^<]*)</div>', 1) AS ad FROM pages), l AS (SELECT page_id, count(DISTINCT u) AS n FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1)) AS u FROM p) WHERE u <> '' GROUP BY 1) SELECT page_id, NULL::VARCHAR AS expose_id, coalesce({_PLAIN_TEXT.format('h')}, {_PLAIN_TEXT.format('t')}) AS name, n::INT AS n_documents, 0 AS n_images, 0 AS n_attributes, NULL::VARCHAR AS ld_name, {_PLAIN_TEXT.format('ad')} AS intro, coalesce(lower({_PLAIN_TEXT.format('t')}) = 'ich bin kein roboter', false) OR coalesce(lower({_PLAIN_TEXT.format('h')}) = 'ich bin kein roboter', false) AS challenge FROM p LEFT JOIN l USING (page_id)")
def listing_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structured records of whole pages, flattened to counts and keys."""
    out = html.listing_records(table(spark, sf_dir, "pages"), fields={"intro": ("class", "ad")})
    return out.select("page_id", "expose_id", "name", F.size("documents").alias("n_documents"), F.size("images").alias("n_images"), F.size("attributes").alias("n_attributes"), F.col("ld.ld_listing_name").alias("ld_name"), F.element_at("marked", "intro").alias("intro"), "challenge")


_NUM = "CASE doc_id % 6 WHEN 0 THEN 'Preis 1.234,56 EUR und 3 Zi' WHEN 1 THEN 'frei ab 0' || (doc_id % 9 + 1) || '.01.2026 fuer 900' WHEN 2 THEN 'Scout24 hat ' || doc_id || ' m2' WHEN 3 THEN '60m2' WHEN 4 THEN 'ca. ' || doc_id || ',5 qm' ELSE 'keine Zahl' END"


def _number_text() -> Column:
    d, s = F.col("doc_id"), F.col("doc_id").cast("string")
    return F.when(d % 6 == 0, "Preis 1.234,56 EUR und 3 Zi").when(d % 6 == 1, F.concat(F.lit("frei ab 0"), (d % 9 + 1).cast("string"), F.lit(".01.2026 fuer 900"))).when(d % 6 == 2, F.concat(F.lit("Scout24 hat "), s, F.lit(" m2"))).when(d % 6 == 3, "60m2").when(d % 6 == 4, F.concat(F.lit("ca. "), s, F.lit(",5 qm"))).otherwise("keine Zahl")


_TOK = "[-+]?\\d{1,3}(?:[.\\s]\\d{3})+(?:[.,]\\d+)?|[-+]?\\d+(?:[.,]\\d+)?"


def _token_sql(t: str) -> str:
    """A date, else the first marked number without a letter on either side."""
    marked = f"regexp_replace(replace({t}, chr(160), ' '), '({_TOK})', chr(1) || '\\1' || chr(2), 'g')"
    return f"coalesce(nullif(regexp_extract(replace({t}, chr(160), ' '), '\\b(\\d{{1,2}}\\.\\d{{1,2}}\\.\\d{{2,4}})\\b', 1), ''), nullif(regexp_extract({marked}, '(?:^|[^\\p{{L}}])' || chr(1) || '([^' || chr(2) || ']*)' || chr(2) || '(?:$|[^\\p{{L}}])', 1), ''))"


@query(f"WITH t AS (SELECT doc_id, {_NUM} AS t, text FROM documents) SELECT doc_id, {_token_sql('t')} AS token, {_token_sql('text')} AS text_token FROM t")
def number_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.number_token(_number_text()).alias("token"), T.number_token(F.col("text")).alias("text_token"))


_P = "CASE o_orderkey % 7 WHEN 0 THEN floor(o_totalprice)::BIGINT::VARCHAR WHEN 1 THEN '1.' || lpad((o_orderkey % 1000)::VARCHAR, 3, '0') WHEN 2 THEN '12.' || (100 + o_custkey % 900) || ',5' WHEN 3 THEN '1.250.000' WHEN 4 THEN (o_custkey % 90) || ',25' WHEN 5 THEN '12,345.5' ELSE 'abc' END"


def _price_text() -> Column:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    s = lambda x: x.cast("string")
    return F.when(k % 7 == 0, s(F.floor("o_totalprice").cast("long"))).when(k % 7 == 1, F.concat(F.lit("1."), F.lpad(s(k % 1000), 3, "0"))).when(k % 7 == 2, F.concat(F.lit("12."), s(100 + c % 900), F.lit(",5"))).when(k % 7 == 3, "1.250.000").when(k % 7 == 4, F.concat(s(c % 90), F.lit(",25"))).when(k % 7 == 5, "12,345.5").otherwise("abc")


@query(f"WITH p AS (SELECT o_orderkey, {_P} AS t FROM orders) SELECT o_orderkey, t AS token, TRY_CAST(CASE WHEN length(t) - length(replace(t, '.', '')) > 1 AND NOT contains(t, ',') THEN NULL WHEN contains(t, ',') AND contains(t, '.') THEN CASE WHEN instr(reverse(t), ',') < instr(reverse(t), '.') THEN replace(replace(t, '.', ''), ',', '.') ELSE replace(t, ',', '') END WHEN contains(t, ',') THEN replace(t, ',', '.') WHEN regexp_matches(t, '^-?\\d{{1,3}}(\\.\\d{{3}})+$') THEN replace(t, '.', '') ELSE t END AS DOUBLE) AS number FROM p")
def parse_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "orders").select("o_orderkey", _price_text().alias("token"))
    return p.select("o_orderkey", "token", T.parse_number(F.col("token")).alias("number"))


@query(f"WITH p AS (SELECT o_orderkey, {_P} || ' €' AS t FROM orders), q AS (SELECT o_orderkey, regexp_replace(trim(t), '€|EUR|m²|qm|[ \\x{{A0}}]', '', 'g') AS t FROM p), r AS (SELECT o_orderkey, CASE WHEN length(t) - length(replace(t, ',', '')) = 1 AND contains(t, '.') THEN replace(replace(t, '.', ''), ',', '.') WHEN length(t) - length(replace(t, ',', '')) = 1 THEN replace(t, ',', '.') ELSE t END AS t FROM q) SELECT o_orderkey, TRY_CAST(regexp_replace(t, '[^0-9.+-]', '', 'g') AS DOUBLE) AS amount FROM r")
def as_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", T.as_float(F.concat(_price_text(), F.lit(" €"))).alias("amount"))


_ADDR = "CASE c_custkey % 5 WHEN 0 THEN 'Haupt Str. ' || c_custkey || 'a, ' || (10000 + c_custkey) || ' Berlin, Mitte' WHEN 1 THEN 'Mitte, ' || (10000 + c_custkey) || ' Bad  Ort' WHEN 2 THEN (10000 + c_custkey) || ' Köln Die vollständige Adresse folgt' WHEN 3 THEN 'Am 7. Tor, Hof' ELSE '' END"


def _address() -> Column:
    c, s, z = F.col("c_custkey"), F.col("c_custkey").cast("string"), (10000 + F.col("c_custkey")).cast("string")
    return F.when(c % 5 == 0, F.concat(F.lit("Haupt Str. "), s, F.lit("a, "), z, F.lit(" Berlin, Mitte"))).when(c % 5 == 1, F.concat(F.lit("Mitte, "), z, F.lit(" Bad  Ort"))).when(c % 5 == 2, F.concat(z, F.lit(" Köln Die vollständige Adresse folgt"))).when(c % 5 == 3, "Am 7. Tor, Hof").otherwise("")


_CUT = "regexp_replace({0}, '(?i)\\bDie vollständige Adresse.*$', '')"
_PARTS = f"a AS (SELECT c_custkey, {_ADDR} AS raw FROM customer), c AS (SELECT c_custkey, raw, trim(regexp_replace({_CUT.format('trim(raw)')}, '[ \\t-\\r]+', ' ', 'g')) AS t FROM a), p AS (SELECT *, nullif(regexp_extract(t, '\\b(\\d{{5}})\\b', 1), '') AS postcode FROM c), q AS (SELECT *, CASE WHEN postcode IS NULL THEN t ELSE trim(t[:instr(t, postcode) - 1], ' ,') END AS before, CASE WHEN postcode IS NOT NULL THEN trim(t[instr(t, postcode) + 5:], ' ,') END AS after FROM p), l AS (SELECT *, trim(split_part(before, ',', 1)) AS lead FROM q)"


@query(f"WITH {_PARTS} SELECT c_custkey, CASE WHEN regexp_matches(lead, '\\d') THEN CASE WHEN regexp_matches(lead, '^.+? +\\d+[a-zA-Z]?$') THEN trim(regexp_extract(lead, '^(.+?) +(\\d+[a-zA-Z]?)$', 1)) ELSE lead END END AS street, CASE WHEN regexp_matches(lead, '\\d') THEN nullif(regexp_extract(lead, '^(.+?) +(\\d+[a-zA-Z]?)$', 2), '') END AS housenumber, postcode, nullif(trim(split_part(after, ',', 1)), '') AS city, CASE WHEN NOT regexp_matches(lead, '\\d') THEN nullif(lead, '') END AS district FROM l")
def parse_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "customer").select("c_custkey", T.parse_address(_address()).alias("a"))
    return a.select("c_custkey", "a.street", "a.housenumber", "a.postcode", "a.city", "a.district")


@query(f"SELECT c_custkey, nullif(trim(split_part(trim(split_part(trim(regexp_extract(trim(raw), '\\b\\d{{5}}\\b(.*)$', 1), ' ,'), ',', 1)), ' Die vollständige', 1)), '') AS city FROM (SELECT c_custkey, {_ADDR} AS raw FROM customer)")
def city_from_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", T.city_from_address(_address()).alias("city"))


_WORDS = {"a": ["the", "ing", "tion"], "b": ["idiot", "http", "de la", "und", "que", "heit"]}


def _kw(words: list[str]) -> str:
    hits = " + ".join(f"contains(lower(coalesce(text, '')), '{w}')::INT" for w in words)
    return f"least(1.0, ({hits}) / {float(min(5, len(words)))}::DOUBLE)"


@query(f"SELECT doc_id, {', '.join(f'round({_kw(w)}, 6) AS kw_{k}' for k, w in _WORDS.items())} FROM documents")
def keyword_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", *[F.round(T.keyword_score(F.col("text"), w), 6).alias(f"kw_{k}") for k, w in _WORDS.items()])


@query("WITH b AS (SELECT CASE WHEN i > 0 THEN 100000 + (i - 1) * 10000 END AS lo, CASE WHEN i < 41 THEN 100000 + i * 10000 END AS hi, i::INT AS bucket FROM range(42) r(i)) SELECT bucket, lo::BIGINT AS lo, hi::BIGINT AS hi, count(o_orderkey) AS n FROM b LEFT JOIN orders ON (lo IS NULL OR o_totalprice >= lo) AND (hi IS NULL OR o_totalprice < hi) GROUP BY ALL")
def price_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per price range; the range number is computed, so no range join is needed."""
    ranges = [(i, lo, hi) for i, (lo, hi) in enumerate(T.price_buckets(100_000, 10_000, 500_000))]
    b = spark.createDataFrame(ranges, "bucket int, lo long, hi long")
    own = F.greatest(F.lit(0), F.least(F.lit(41), F.floor((F.col("o_totalprice") - 90_000) / 10_000))).cast("int")
    n = table(spark, sf_dir, "orders").groupBy(own.alias("bucket")).agg(F.count("*").alias("n"))
    return b.join(n, "bucket", "left").select("bucket", "lo", "hi", F.coalesce("n", F.lit(0)).alias("n"))


@query("WITH h AS (SELECT o_orderkey, ('0x' || sha256('42:' || o_orderkey)[1:4])::INT / 65535.0::DOUBLE AS u FROM orders) SELECT o_orderkey, round(u, 6) AS u, CASE WHEN u < 0.8 THEN 'train' WHEN u < 0.9 THEN 'val' ELSE 'test' END AS split FROM h")
def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey").cast("string")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.round(T.hash_fraction(k, 42), 6).alias("u"), T.split_name(k, 42).alias("split"))


@query("SELECT p_partkey, TRY_CAST(nullif(regexp_extract(lower(s), '(\\d{1,3})', 1), '') AS INT) AS speed, TRY_CAST(nullif(regexp_extract(lower(s), '(\\d+)', 1), '') AS INT) AS any_speed FROM (SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN p_size || ' mph' WHEN 1 THEN 'DE:' || p_partkey || '000' WHEN 2 THEN 'none' ELSE p_size::VARCHAR END AS s FROM part)")
def max_speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    z = F.col("p_size")
    s = F.when(z % 4 == 0, F.concat(z.cast("string"), F.lit(" mph"))).when(z % 4 == 1, F.concat(F.lit("DE:"), F.col("p_partkey").cast("string"), F.lit("000"))).when(z % 4 == 2, "none").otherwise(z.cast("string"))
    return table(spark, sf_dir, "part").select("p_partkey", T.max_speed(s).alias("speed"), T.max_speed(s, any_length=True).alias("any_speed"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 3 = 2 THEN NULL WHEN l_linenumber % 3 = 1 THEN (l_orderkey % 30) * 3600 + (l_partkey % 60) * 60 ELSE (l_orderkey % 30) * 3600 + (l_partkey % 60) * 60 + l_suppkey % 60 END::INT AS seconds FROM lineitem")
def gtfs_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    h, m, s, n = F.col("l_orderkey") % 30, F.col("l_partkey") % 60, F.col("l_suppkey") % 60, F.col("l_linenumber") % 3
    t = F.when(n == 2, F.format_string("%d:%02d", h, 60 + m)).when(n == 1, F.format_string("%d:%02d", h, m)).otherwise(F.format_string("%d:%02d:%02d", h, m, s))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", T.gtfs_seconds(t).alias("seconds"))


@query("WITH r AS (SELECT event_type, lower(trim([' Yes', '1', 'NO', 'false', 'limited', ''][event_id % 6 + 1])) AS s FROM events) SELECT event_type, count(*) FILTER (WHERE s IN ('yes', 'true', '1')) AS lit_yes, count(*) FILTER (WHERE s IN ('no', 'false', '0')) AS lit_no, count(*) FILTER (WHERE s NOT IN ('yes', 'true', '1', 'no', 'false', '0')) AS lit_other FROM r GROUP BY 1")
def lit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.element_at(F.array(*map(F.lit, [" Yes", "1", "NO", "false", "limited", ""])), (F.col("event_id") % 6 + 1).cast("int"))
    e = table(spark, sf_dir, "events").select("event_type", T.lit_state(raw).alias("s"))
    return e.groupBy("event_type").agg(*[F.count_if(F.col("s") == k).alias(f"lit_{k}") for k in ("yes", "no", "other")])


@query("WITH r AS (SELECT page_id, CASE page_id % 8 WHEN 0 THEN NULL WHEN 1 THEN 'ERROR 500' WHEN 2 THEN html || '<a>clickout</a>' WHEN 3 THEN '' ELSE html END AS h, page_id % 3 = 0 AS ld, page_id % 5 = 0 AS off, page_id % 7 = 0 AS ch FROM pages) SELECT CASE WHEN (h IS NULL OR starts_with(h, 'ERROR') OR trim(h) = '') THEN CASE WHEN off THEN 'skipped' WHEN ld THEN 'good' ELSE 'failed' END WHEN contains(lower(h), 'clickout') OR contains(lower(h), '> quelle :') THEN 'skipped' WHEN ch THEN 'failed' ELSE 'good' END AS route, count(*) AS n FROM r GROUP BY 1")
def route_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("page_id")
    h = F.when(p % 8 == 0, F.lit(None).cast("string")).when(p % 8 == 1, "ERROR 500").when(p % 8 == 2, F.concat("html", F.lit("<a>clickout</a>"))).when(p % 8 == 3, "").otherwise(F.col("html"))
    made = table(spark, sf_dir, "pages").select(h.alias("h"), (p % 3 == 0).alias("ld"), (p % 5 == 0).alias("off"), (p % 7 == 0).alias("ch"))
    return made.select(records.route(F.col("h"), F.col("ld"), F.col("off"), F.col("ch")).alias("route")).groupBy("route").agg(F.count("*").alias("n"))


@query("SELECT page_id, sha256(coalesce(html, '')) AS html_sha256, sha1(url)[1:12] AS url_sha1, url || '|' || sha256(coalesce(html, '')) AS done_key FROM pages")
def content_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    sha = F.sha2(F.encode(F.coalesce(F.col("html"), F.lit("")), "utf-8"), 256)
    return table(spark, sf_dir, "pages").select("page_id", sha.alias("html_sha256"), T.short_sha1(F.col("url")).alias("url_sha1"), T.done_key(F.col("url"), sha).alias("done_key"))


@query("SELECT conv_id, string_agg(coalesce(text, ''), ' ' ORDER BY turn, text) AS body FROM conversations GROUP BY 1")
def listing_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.coalesce("text", F.lit("")).alias("text")))).alias("t"))
    return c.select("conv_id", F.array_join(F.transform("t", lambda x: x.text), " ").alias("body"))


@query("SELECT doc_id, md5(coalesce(source, '') || ' ' || coalesce(CASE WHEN doc_id % 3 > 0 THEN lang END, '') || ' ' || coalesce(text, '')) AS body_md5 FROM documents")
def composed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title, description and place of a record as one text, missing parts as blanks."""
    body = T.listing_text(F.col("source"), F.when(F.col("doc_id") % 3 > 0, F.col("lang")), F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(F.encode(body, "utf-8")).alias("body_md5"))


@query("SELECT page_id, CASE WHEN page_id % 4 < 3 THEN 1000 + page_id % 1000 END AS total, least(greatest(page_id % 40, page_id % 23), ceil((CASE WHEN page_id % 4 < 3 THEN 1000 + page_id % 1000 END) / 20.0))::INT AS pages FROM pages")
def page_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Announced total, as a heading or in a sentence and in any case, and number of result pages, from marks in the markup."""
    p = F.col("page_id")
    s = lambda c: c.cast("string")
    number = F.concat(F.lit("1."), F.lpad(s(p % 1000), 3, "0"))
    told = F.when(p % 4 == 0, F.concat(F.lit("<span> "), number, F.lit(" eigentumswohnungen IN Ort</span>"))).when(p % 4 == 1, F.concat(F.lit("<p>In Ort findest du derzeit "), number, F.lit(" Eigentumswohnungen.</p>")))
    told = told.when(p % 4 == 2, F.concat(F.lit("<b>... Eigentumswohnungen in Ort</b> findest Du derzeit "), number, F.lit(" Eigentumswohnungen"))).otherwise(F.concat(F.lit("<b>mit "), number, F.lit(" Eigentumswohnungen</b>")))
    body = F.concat("html", told, F.lit('<a data-p="'), s(p % 40), F.lit('">x</a><a href="?p='), s(p % 23), F.lit('">y</a>'))
    rows = table(spark, sf_dir, "pages").select("page_id", body.alias("html"))
    total = html.total_count(F.col("html"))
    return rows.select("page_id", total.cast("long").alias("total"), html.page_count(F.col("html"), total, 20).alias("pages"))


@query("SELECT page_id, page_id || '' AS listing_id, 'p-' || (page_id % 9) AS provider_id, CASE WHEN page_id % 3 > 0 THEN 48.0::DOUBLE + page_id % 7 END AS latitude, CASE WHEN page_id % 3 > 0 THEN -9.5::DOUBLE END AS longitude FROM pages")
def page_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Portal ids and coordinates that page scripts set; both coordinates or none."""
    p, s = F.col("page_id"), F.col("page_id").cast("string")
    script = F.concat(F.lit("latitude = "), (48 + p % 7).cast("string"), F.lit(".0;"), F.when(p % 3 > 0, " longitude = -9.5;").otherwise(""))
    body = F.concat("html", F.lit("<p>Portal-ID: "), s, F.lit(" Anbieter-ID: p-"), (p % 9).cast("string"), F.lit("</p><script>"), script, F.lit("</script>"))
    got = table(spark, sf_dir, "pages").select("page_id", html.ids_and_coordinates(body, listing_key="Portal-ID").alias("i"))
    return got.select("page_id", "i.listing_id", "i.provider_id", "i.coordinates.latitude", "i.coordinates.longitude")


@query("SELECT c_custkey, (c_custkey % 1000) || ',5 m²' AS wohnflaeche, c_mktsegment AS art, c_custkey % 1000 + 0.5::DOUBLE AS area, 'Text zu ' || c_name AS about, 4 AS n_details FROM customer")
def listing_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards, headed lists with their numbers and headed texts of listing pages built from customers."""
    s = (F.col("c_custkey") % 1000).cast("string")
    page = F.concat(F.lit('<div id="expose-info-details"><div><div>'), s, F.lit(",5 m²</div><div>Wohnfläche</div></div><div><div> </div></div></div><h2>Details</h2><ul><li><div>Art</div><div>"), "c_mktsegment", F.lit("</div></li><li>Etage: 3</li><li><div>nur eins</div></li></ul><h3>Kosten im Monat</h3><ul><li><div>Miete</div><div>1.250 EUR</div></li></ul><h2>Lage</h2><div id='extendedText-print'>Druck</div><div class='x-print'>Druck</div><p>Text zu "), "c_name", F.lit("</p><p>mehr</p>"))
    out = html.listing_records(table(spark, sf_dir, "customer").select("c_custkey", F.lit("https://x.example/").alias("url"), page.alias("html")))
    return out.select("c_custkey", F.col("details.wohnflache").alias("wohnflaeche"), F.col("details.art").alias("art"), F.col("numbers.wohnflache_num").alias("area"), html.section_text(F.col("texts"), "lage").alias("about"), F.size("details").alias("n_details"))


@query("SELECT o_orderkey, floor(o_totalprice)::BIGINT || ' EUR' AS rent, CASE WHEN o_orderkey % 3 > 0 THEN 'Gas ' || o_custkey END AS heating, CASE WHEN o_orderkey % 3 > 0 THEN 1 ELSE 0 END AS n_energy, CASE o_orderkey % 4 WHEN 0 THEN 'A+' WHEN 1 THEN 'Klasse ' || o_orderstatus WHEN 2 THEN 'B' END AS energy_class FROM orders")
def heading_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists chosen by the heading above them, and an energy class that may be the text of an image inside its element."""
    k, s = F.col("o_orderkey"), lambda c: c.cast("string")
    rent = F.concat(s(F.floor("o_totalprice").cast("long")), F.lit(" EUR"))
    item = lambda name, value: F.concat(F.lit(f"<li><div>{name}</div><div>"), value, F.lit("</div></li>"))
    energy = F.when(k % 3 > 0, F.concat(F.lit("<h3>Energie und Heizung</h3><ul>"), item("Heizung", F.concat(F.lit("Gas "), s(F.col("o_custkey")))), F.lit("</ul>"))).otherwise("")
    marked = F.when(k % 4 == 0, '<dd class="energy"><span><img src="a.png" alt=" A+ "></span></dd>').when(k % 4 == 1, F.concat(F.lit('<dd class="energy"><img src="x.png">Klasse '), "o_orderstatus", F.lit("</dd>")))
    marked = marked.when(k % 4 == 2, '<dd class="energy">Klasse <img alt="B"><img alt="C"></dd>').otherwise("")
    page = F.concat(F.lit("<h2>Die Kosten</h2><ul>"), item("Miete", rent), item("Miete", F.lit("0 EUR")), F.lit("</ul><h2>Immobiliendetails</h2><ul>"), item("Heizung", F.lit("keine")), F.lit("</ul>"), energy, F.lit("<h2>Weitere Kosten</h2><ul>"), item("Kaution", F.lit("1")), F.lit("</ul>"), marked)
    walked = html.walk_pages(table(spark, sf_dir, "orders").select("o_orderkey", page.alias("html")), fields={"energy": ("class", "energy")})
    costs, power = html.section_map(F.col("lists"), "kosten"), html.section_map(F.col("lists"), "Energie")
    value = lambda m, n: F.try_element_at(m, F.lit(n))
    return walked.select("o_orderkey", value(costs, "miete").alias("rent"), value(power, "heizung").alias("heating"), F.size(power).alias("n_energy"), value(F.col("marked"), "energy").alias("energy_class"))


_ROBOT = "c_custkey % 11 = 0"


@query(f"SELECT c_custkey, c_custkey::VARCHAR AS expose_id, CASE WHEN {_ROBOT} THEN 'Ich bin kein Roboter' ELSE c_name END AS name, {_ROBOT} AS challenge, (c_custkey % 4)::INT AS n_images, sha256('https://x.example/i/' || c_custkey || '-0.jpg') AS first_image, CASE WHEN c_custkey % 5 > 0 THEN 2 ELSE 1 END AS n_attributes, c_mktsegment AS segment, CASE WHEN c_custkey % 5 > 0 THEN floor(c_acctbal)::BIGINT::VARCHAR END AS balance, CASE WHEN c_custkey % 3 > 0 THEN c_name || ' & Co' END AS ld_name, CASE WHEN c_custkey % 3 > 0 THEN (c_custkey % 997)::VARCHAR END AS ld_price, CASE WHEN c_custkey % 3 = 2 THEN 'https://x.example/w' END AS ld_page FROM customer WHERE c_custkey % 4 > 0 UNION ALL SELECT c_custkey, c_custkey::VARCHAR, CASE WHEN {_ROBOT} THEN 'Ich bin kein Roboter' ELSE c_name END, {_ROBOT}, 0, NULL, CASE WHEN c_custkey % 5 > 0 THEN 2 ELSE 1 END, c_mktsegment, CASE WHEN c_custkey % 5 > 0 THEN floor(c_acctbal)::BIGINT::VARCHAR END, CASE WHEN c_custkey % 3 > 0 THEN c_name || ' & Co' END, CASE WHEN c_custkey % 3 > 0 THEN (c_custkey % 997)::VARCHAR END, CASE WHEN c_custkey % 3 = 2 THEN 'https://x.example/w' END FROM customer WHERE c_custkey % 4 = 0")
def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of listing pages built from customers: ids, images, pairs, JSON-LD as an object or a graph, robot checks."""
    k, s = F.col("c_custkey"), F.col("c_custkey").cast("string")
    head = F.when(k % 11 == 0, "<h1>Ich bin kein Roboter</h1>").otherwise(F.concat(F.lit("<h1> "), "c_name", F.lit("</h1>")))
    images = F.array_join(F.transform(F.when(k % 4 > 0, F.sequence(F.lit(0), (k % 4 - 1).cast("int"))).otherwise(F.array().cast("array<int>")), lambda i: F.concat(F.lit('<img src="/i/'), s, F.lit("-"), i.cast("string"), F.lit('.jpg"><img src="data:image/png;x">'))), "")
    pairs = F.concat(F.lit("<dl><dt>Segment</dt><dd>"), "c_mktsegment", F.lit("</dd><dt>only the first pair of a list counts</dt><dd>x</dd></dl>"), F.when(k % 5 > 0, F.concat(F.lit("<dl><dt>Balance</dt><dd>"), F.floor("c_acctbal").cast("long").cast("string"), F.lit("</dd></dl><dl><dt>balance</dt><dd>x</dd></dl>"))).otherwise(""))
    listing = F.concat(F.lit('{"@type": "RealEstateListing", "name": "'), "c_name", F.lit(' & Co", "offers": [{"price": "'), (k % 997).cast("string"), F.lit('"}]}'))
    graph = F.when(k % 3 == 1, listing).when(k % 3 == 2, F.concat(F.lit('{"@graph": [{"@type": "WebPage", "@id": "https://x.example/w"}, '), listing, F.lit("]}")))
    ld = F.when(graph.isNotNull(), F.concat(F.lit('<script type="application/ld+json">{broken</script><script type="application/ld+json">'), graph, F.lit("</script>"))).otherwise("")
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("https://x.example/expose/"), s, F.lit("?a=1")).alias("url"), F.concat(head, images, pairs, ld).alias("html"))
    out = html.listing_records(rows)
    attr = lambda n: F.try_element_at("attributes", F.lit(n))
    return out.select("c_custkey", "expose_id", "name", "challenge", F.size("images").alias("n_images"), F.get("images", F.lit(0))["sha256"].alias("first_image"), F.size("attributes").alias("n_attributes"), attr("segment").alias("segment"), attr("balance").alias("balance"), F.col("ld.ld_listing_name").alias("ld_name"), F.col("ld.ld_offer_price").alias("ld_price"), F.col("ld.ld_webpage_url").alias("ld_page"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'ld' WHEN p_partkey % 2 = 0 THEN 'dl' ELSE 'base' END AS name, p_brand AS brand, CASE WHEN p_partkey % 2 = 0 THEN p_type END AS kind FROM part")
def attribute_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes of a record in rising precedence: base, pairs, structured data."""
    p = F.col("p_partkey")
    some = lambda c, m: F.when(c, m).otherwise(F.expr("cast(map() as map<string,string>)"))
    base = F.create_map(F.lit("name"), F.lit("base"), F.lit("brand"), F.col("p_brand"))
    merged = html.merged_attributes(base, some(p % 2 == 0, F.create_map(F.lit("name"), F.lit("dl"), F.lit("kind"), F.col("p_type"))), some(p % 3 == 0, F.create_map(F.lit("name"), F.lit("ld"))))
    return table(spark, sf_dir, "part").select("p_partkey", merged.alias("m")).select("p_partkey", "m.name", "m.brand", F.try_element_at("m", F.lit("kind")).alias("kind"))


@query("SELECT event_id, json_extract(props, '$.k')::INT AS k, NULL::VARCHAR AS deep FROM events")
def nested_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null-safe look-up below a chain of keys."""
    v = F.try_parse_json("props")
    return table(spark, sf_dir, "events").select("event_id", T.nested(v, "k", kind="int").alias("k"), T.nested(v, "k", "x", "y").alias("deep"))


@query("SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 're') OR contains(lower(p_name), 'an') ORDER BY p_partkey LIMIT 40")
def name_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 40 parts whose name has one of the needles, whatever the case."""
    return records.name_filter(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_name", ["RE", "an"], order="p_partkey", first=40)


@query("SELECT street, row_number() OVER (ORDER BY lower(street)) AS place FROM (SELECT DISTINCT p_brand AS street FROM part)")
def streets_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streets in the order of their lower-cased names, numbered by sorted ranges."""
    names = staged(table(spark, sf_dir, "part").select(F.col("p_brand").alias("street")).distinct())
    return records.by_name(ranked(names, [], [F.lower("street")], "place"), "street").select("street", (F.col("place") + 1).alias("place"))


@query("SELECT l_suppkey AS grp, 'u' || l_partkey AS link FROM lineitem WHERE l_linenumber <= 3 UNION SELECT l_suppkey, 'u' || l_partkey FROM lineitem WHERE l_linenumber >= 3")
def link_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of two crawls, each once."""
    rows = table(spark, sf_dir, "lineitem").select("l_linenumber", F.col("l_suppkey").alias("grp"), F.concat(F.lit("u"), F.col("l_partkey").cast("string")).alias("link"))
    return records.union_links(*[rows.where(c).select("grp", "link") for c in ("l_linenumber <= 3", "l_linenumber >= 3")])
