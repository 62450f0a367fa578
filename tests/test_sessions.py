import random

from foliospark.operators.sessions import distinct_events, marked_events, sessions

SCHEMA = "id string, user_id string, us bigint, query_text string"
MIN = 60_000_000


def brute(rows, gap):
    seen, per = {}, {}
    for i, u, t, _ in rows:
        if u is None or t is None:
            continue
        if i is not None:
            seen.setdefault(i, []).append((t, u))
        else:
            per.setdefault(u, []).append(t)
    for v in seen.values():
        t, u = min(v)
        per.setdefault(u, []).append(t)
    out = []
    for u, ts in per.items():
        ts.sort()
        start, n, last = ts[0], 0, ts[0]
        for t in ts:
            if t - last > gap:
                out.append((u, start, last, n))
                start, n = t, 0
            n, last = n + 1, t
        out.append((u, start, last, n))
    return sorted(out)


def test_against_brute_force_with_a_hot_user(spark):
    r = random.Random(3)
    rows = [(f"i{r.randrange(900)}" if r.random() < 0.95 else None, r.choice(["hot"] * 4 + ["a", "b", None]), r.choice([None] + [r.randrange(0, 4 * 24 * 60) * MIN for _ in range(30)]), "q") for _ in range(1500)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sessions(distinct_events(df, "id", "user_id", "us"), slab_us=60 * MIN).select("user_id", "start_us", "end_us", "n_events")
    assert sorted(map(tuple, got.collect())) == brute(rows, 30 * MIN)


def test_gap_of_exactly_thirty_minutes_and_slab_borders(spark):
    rows = [("1", "u", 0, "a"), ("2", "u", 30 * MIN, "b"), ("3", "u", 60 * MIN + 1, "c"), ("4", "u", 24 * 60 * MIN - 1, "d"), ("5", "u", 24 * 60 * MIN, "e"), ("5", "u", 24 * 60 * MIN, "e")]
    got = sessions(distinct_events(spark.createDataFrame(rows, SCHEMA), "id", "user_id", "us")).orderBy("start_us").collect()
    assert [(x.start_us, x.end_us, x.n_events) for x in got] == [(0, 30 * MIN, 2), (60 * MIN + 1, 60 * MIN + 1, 1), (24 * 60 * MIN - 1, 24 * 60 * MIN, 2)]


def test_empty_and_extra_columns(spark):
    df = spark.createDataFrame([], SCHEMA + ", slab bigint, n bigint, e string")
    assert sessions(distinct_events(df, "id", "user_id", "us")).count() == 0
    assert marked_events(distinct_events(df, "id", "user_id", "us")).count() == 0
