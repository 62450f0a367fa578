import random

from foliospark.operators.references import orphan_references

REF = "tab string, rec_id string, kind string, key string, ref_us bigint, month string, gone string"
PAR = "kind string, key string, deleted boolean, came_us bigint, rng int"


def test_against_brute_force_in_many_ranges_and_salts(spark):
    r = random.Random(5)
    key = lambda: f"{r.randrange(60):032x}"[::-1]
    parents = [(r.choice("dp"), key(), r.choice([True, False, None]), r.choice([None, 5, 50]), 1) for _ in range(70)]
    refs = [(f"t{r.randrange(2)}", f"r{i % 300}", r.choice("dp"), r.choice([None, key(), "f" * 32]) if r.random() < 0.5 else "0" * 31 + "1", r.choice([None, 10, 100]), "2016-01", "x") for i in range(500)]
    by = {}
    for k, h, d, c, _ in parents:
        g, t = by.get((k, h), (False, None))
        by[k, h] = (g or bool(d), c if t is None else t if c is None else min(c, t))
    want = set()
    for tab, rec, kind, h, us, month, _ in refs:
        if h is None:
            continue
        p = by.get((kind, h))
        reason = "missing" if p is None else "deleted" if p[0] else "late" if us is not None and p[1] is not None and p[1] > us else None
        if reason:
            want.add((tab, rec, month, reason))
    got = orphan_references(spark.createDataFrame(refs, REF), spark.createDataFrame(parents, PAR), range_keys=7, probe_rows=40)
    assert set(map(tuple, got.select("tab", "rec_id", "month", "reason").collect())) == want


def test_empty_tables(spark):
    none = spark.createDataFrame([], REF)
    assert orphan_references(none, spark.createDataFrame([], PAR)).count() == 0
    one = spark.createDataFrame([("t", "r", "d", "a" * 32, 1, "m", "x")], REF)
    assert [x.reason for x in orphan_references(one, spark.createDataFrame([], PAR)).collect()] == ["missing"]
