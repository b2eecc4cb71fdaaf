import random
from datetime import datetime, timedelta

import pytest
from local import frame
from pyspark.sql import functions as F

from lapsewise.operators import asof_join

T0 = datetime(2024, 1, 1)
LEFT = "k bigint, lt timestamp_ntz, l bigint"
RIGHT = "k bigint, rt timestamp_ntz, r bigint, maybe double"


def expected(left, right):
    rows = set()
    for k, lt, l in left:
        earlier = [r for r in right if r[0] == k and r[1] is not None and r[1] <= lt]
        if earlier:
            _, rt, r, maybe = max(earlier, key=lambda x: x[1])
            rows.add((k, lt, l, rt, r, maybe))
    return rows


@pytest.mark.parametrize("bucket", [None, "day", "month"])
@pytest.mark.parametrize("seed", range(2))
def test_against_the_definition(spark, seed, bucket):
    rng = random.Random(seed)

    def time():
        return T0 + timedelta(hours=rng.randrange(24 * 70))

    left = [(rng.choice([1, 1, 2, 3]), time(), i) for i in range(150)]
    right = {(k, t): None for k, t in ((rng.choice([1, 1, 2]), time()) for _ in range(60))}
    right = [(k, t, i, rng.choice([None, 1.5])) for i, (k, t) in enumerate(right)]
    joined = asof_join(
        frame(spark, left, LEFT), frame(spark, right, RIGHT), ["k"], "lt", "rt", bucket
    )
    got = [tuple(r) for r in joined.select("k", "lt", "l", "rt", "r", "maybe").collect()]
    assert set(got) == expected(left, right) and len(got) == len(set(got))


def test_null_members_are_carried_not_skipped(spark):
    left = frame(spark, [(1, T0 + timedelta(days=3), 0)], LEFT)
    right = frame(spark, 
        [(1, T0, 1, 9.0), (1, T0 + timedelta(days=1), 2, None)], RIGHT
    )
    for bucket in (None, "day"):
        row = asof_join(left, right, ["k"], "lt", "rt", bucket).first()
        assert (row["r"], row["maybe"]) == (2, None)


def test_same_name_on_both_sides_is_refused(spark):
    left = frame(spark, [(1, T0, 0)], LEFT)
    with pytest.raises(ValueError, match="both sides"):
        asof_join(left, left.withColumn("rt", F.col("lt")), ["k"], "lt", "rt")
