"""Episodes and first-later times against plain Python."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tte.operators.episodes import episodes, first_after

T0 = dt.datetime(2024, 1, 1)


def rows(seed, n=300):
    rng = random.Random(seed)
    return [(i, rng.choice(["hot"] * 4 + ["a", "b", "c"]), T0 + dt.timedelta(seconds=rng.randint(0, 400)), rng.choice(["s", "e", "x"]), float(i))
            for i in range(n)] + [(n, None, T0, "s", 0.0), (n + 1, "a", None, "e", 0.0)]


def test_episodes_by_definition(spark):
    data = rows(1)
    df = spark.createDataFrame(data, "id long, who string, at timestamp, kind string, v double")
    got = {r.episode_id: (r.who, r.end_s - r.start_s, r.event, r.v) for r in
           episodes(df, "who", "at", "id", F.col("kind") == "s", F.col("kind") == "e", carry=["v"]).collect()}
    end = max(r[2] for r in data if r[2])
    want = {}
    for i, who, at, kind, v in data:
        if kind == "s" and who is not None:
            nexts = [r[2] for r in data if r[1] == who and r[3] == "s" and r[2] and r[2] > at]
            stop = min(nexts, default=end)
            # an end belongs to the last start strictly before it
            hits = [r[2] for r in data if r[1] == who and r[3] == "e" and r[2] and at < r[2] <= stop]
            want[i] = (who, ((min(hits) if hits else stop) - at).total_seconds(), int(bool(hits)), v)
    same_time = {(r[1], r[2]) for r in data if r[3] == "s" and sum(q[1] == r[1] and q[2] == r[2] and q[3] == "s" for q in data) > 1}
    for i, w in want.items():
        who, at = next((r[1], r[2]) for r in data if r[0] == i)
        if (who, at) not in same_time:  # of starts at one instant only one can own the next end
            assert got[i] == w
    assert set(got) == set(want)


def test_first_after(spark):
    data = rows(2)
    df = spark.createDataFrame(data, "id long, who string, at timestamp, kind string, v double")
    left, right = df.where("kind = 's'"), df.where("kind = 'e'")
    for r in first_after(left, right, "who", "at", "at").collect():
        later = [x[2] for x in data if x[1] == r.who and x[3] == "e" and x[2] and r.at and x[2] > r.at] if r.who else []
        assert r.first_after == min(later, default=None)
