"""Golden values of the column functions."""

import math

import pytest
from pyspark.sql import functions as F

from geolist.functions import geo, scores
from geolist.functions import text as T


def values(spark, rows, fn, kind="string"):
    df = spark.createDataFrame([(r,) for r in rows], f"x {kind}")
    return [r[0] for r in df.select(fn(F.col("x")).alias("y")).collect()]


CASES = [
    (T.parse_number, {"12.345,67": 12345.67, "12,345.67": 12345.67, "12,5": 12.5, "1.234": 1234.0, "1.250.000": None, "01.01.2026": None, "abc": None, "": None, None: None}),
    (T.number_token, {"Portal24 ist 3,5 Zi": "3,5", "frei ab 01.01.2026": "01.01.2026", "60m²": None, "60 m²": "60", "kein": None, None: None}),
    (T.as_float, {"1.234,56 €": 1234.56, "1.234": 1.234, "": None, None: None, "85 m²": 85.0}),
    (T.gtfs_seconds, {"25:10:00": 90600, "7:05": 25500, "7:61": None, "": None, None: None}),
    (T.canonical_url, {"https://x.de/a?utm_s=1&b=2&ref=q&c=": "https://x.de/a?b=2&c=", "https://x.de/a": "https://x.de/a", "https://x.de/?ref=1#f": "https://x.de/#f"}),
    (T.expose_id, {"https://x.de/expose/123?a=1": "123", "https://x.de/?exposeId=77": "77", "https://x.de/?exposeid=7a": None, "": None}),
    (T.clean, {" a  b\n": "a b", " ": None, None: None}),
    (T.slugify, {"Größe m²": "groe_m", "Äpfel & Öl": "apfel_ol", "": "field", None: None}),
    (T.slugify_city, {"Frankfurt/Main": "frankfurt-main", "Gießen Süd": "giessen-sued"}),
    (T.city_from_address, {"X 1, 10115 Berlin, Mitte": "Berlin", "ohne": None, "": None}),
    (T.max_speed, {"50": 50, "30 mph": 30, "none": None, None: None}),
    (T.lit_state, {"yes": "yes", "NO": "no", "limited": "other"}),
]


@pytest.mark.parametrize("fn,cases", CASES, ids=[f.__name__ for f, _ in CASES])
def test_golden(spark, fn, cases):
    assert values(spark, list(cases), fn) == list(cases.values())


def test_address(spark):
    got = values(spark, ["Hauptstr. 12a, 10115 Berlin, Mitte", "Mitte, 10115 Berlin", None, ""], T.parse_address)
    assert (got[0].street, got[0].housenumber, got[0].postcode, got[0].city) == ("Hauptstr.", "12a", "10115", "Berlin")
    assert got[1].district == "Mitte" and got[1].street is None
    assert got[2].postcode is None and got[3].city is None


def test_multi_group_numbers(spark):
    assert values(spark, ["1.250.000"], lambda c: T.parse_number(c, multi_group=True)) == [1250000.0]


def test_scores(spark):
    assert values(spark, [0.0, 10.0], lambda c: scores.saturating(c, 10.0), "double") == pytest.approx([0, 0.632120558829])
    assert values(spark, [None, 1200.0], lambda c: scores.by_distance(c, 1200.0), "double") == pytest.approx([0, 0.367879441171])
    assert values(spark, [None, 0.5, 7.0], scores.clamp01, "double") == [None, 0.5, 1.0]

    def confidence(method, matched, sampled, known):
        none = F.lit(None)
        return F.round(scores.geocode_confidence(F.lit(method), none.cast("string"), F.lit(matched), F.lit(sampled), none.cast("string"), none.cast("double"), F.lit(known))["confidence"], 12)

    row = spark.range(1).select(confidence("overpass_address", 1, 0, False).alias("a"), confidence("overpass_postcode", 0, 60, False).alias("b"), confidence("overpass_postcode", 0, 60, True).alias("c")).first()
    assert tuple(row) == pytest.approx((0.96, 0.639636167648, 0.479727125736))


def test_geometry(spark):
    row = spark.range(1).select(geo.segment_distance(*[F.lit(float(v)) for v in (0, 5, -1, 0, 1, 0)]).alias("a"), geo.segment_distance(*[F.lit(float(v)) for v in (3, 4, 0, 0, 0, 0)]).alias("b"), geo.haversine(*[F.lit(float(v)) for v in (48, 9, 49, 9)]).alias("c")).first()
    assert row.a == 5.0 and row.b == 5.0 and row.c == pytest.approx(math.pi * 6371000 / 180)


def test_price_buckets():
    got = T.price_buckets(100_000, 10_000, 800_000)
    assert len(got) == 72 and got[0][0] is None and got[-1][1] is None
