import random
from itertools import groupby

from geolist.operators.ranking import ranked, running
from geolist.sources.scratch import staged


def test_running_sums_and_exclusive_ors(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None, "hot", "hot", "hot"]), rng.choice([None, *range(5)]), rng.randrange(-(2**40), 2**40)) for _ in range(5000)]
    df = staged(spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "g string, v long, w long, i long").repartition(7))
    got = running(df, ["g"], ["v", "i"], {"before": "w"}, {"bits": "w"}).collect()
    assert len(got) == len(rows)
    key = lambda r: (r.g is not None, r.g or "", r.v is not None, r.v or 0, r.i)
    for _, own in groupby(sorted(got, key=key), lambda r: r.g):
        total = bits = 0
        for r in own:
            assert (r.before, r.bits) == (total, bits)
            total, bits = total + r.w, bits ^ r.w


def test_ranks_of_equal_rows_and_of_one_group(spark):
    df = staged(spark.range(3000).selectExpr("7L AS v").repartition(5))
    assert sorted(r["rank"] for r in ranked(df, [], ["v"]).collect()) == list(range(3000))
    assert ranked(staged(spark.createDataFrame([], "v long")), [], ["v"]).count() == 0
