"""Per-group scans and key offsets against plain Python, whichever way they are planned."""

from __future__ import annotations

import random
from fractions import Fraction
from itertools import accumulate

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stockweave import session
from stockweave.functions.numbers import scale_of
from stockweave.operators.running import (
    SkewPolicy,
    find_hot_keys,
    key_offsets,
    scan,
    scan_chunks,
    scan_groups,
    split_hot,
)

SCHEMA = "g long, a int, b int, v double"


def expected(rows):
    """(g, a, b, v, seq, before, after) per row; rows are totally ordered by (g, a, b, v)."""
    out, state = [], {}
    for g, a, b, v in sorted(rows, key=lambda r: tuple((x is not None, x or 0) for x in r)):
        seq, total = state.get(g, (0, None))
        after = total if v is None else (total or 0) + v
        out.append((g, a, b, v, seq, total, after))
        state[g] = (seq + 1, after)
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.select("g", "a", "b", "v", "seq", "total_before", "total_after").collect()), key=str)


def skewed_rows(n=600, seed=3):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        g = 1 if rng.random() < 0.4 else rng.randrange(2, 40)
        v = None if rng.random() < 0.1 else float(rng.randrange(-50, 50))
        rows.append((g, rng.choice([None, 1, 2, 3]), rng.randrange(4), v))
    # A group of copies: equal in every column.
    return rows + [(1, 2, 2, 5.0)] * 200


@pytest.mark.parametrize("hot", [[], [1], [1, 2, 3], list(range(1, 40))])
def test_scan_with_any_choice_of_hot_groups(spark, hot):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    keys = spark.createDataFrame([(k,) for k in hot], "g long") if hot else None
    assert result(scan(df, "g", ["a", "b", "v"], "v", keys)) == expected(rows)


def test_fractions_add_up_alike_in_both_plans(spark):
    rng = random.Random(9)
    rows = [(1, i, 0, rng.randrange(-999, 999) / 10) for i in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    whole = result(scan_groups(df, ["g"], ["a", "b", "v"], "v"))
    assert whole == result(scan_chunks(df, "g", ["a", "b", "v"], "v"))
    assert all(after == round(after, 1) for *_, after in whole)


def exact(rows):
    """Like :func:`expected`, sums taken as fractions and rounded once."""
    rows = [(*r[:3], None if r[3] is None else Fraction(r[3])) for r in rows]
    return sorted([(*r[:3], *[x if i == 1 or x is None else float(x) for i, x in enumerate(r[3:])]) for r in expected(rows)], key=str)


NUMBERS = {
    "thirds": [1 / 3, -2 / 3, 7.0, 0.1],
    "far apart": [1e13, 1 / 3, -1e13, 1e-7],
    "large": [1e15, -1e15, 123456789012345.0],
    "binary": [0.5, 0.25, 1e9, -3.125],
    "tiny": [5e-324, 1e-310, -2e-320],
}


@pytest.mark.parametrize("name", NUMBERS)
def test_any_doubles_add_up_exactly(spark, name):
    rng = random.Random(4)
    rows = [(rng.randrange(3), i, 0, rng.choice([None, *NUMBERS[name]])) for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert result(scan_groups(df, ["g"], ["a", "b"], "v")) == exact(rows)
    assert result(scan_chunks(df, "g", ["a", "b"], "v")) == exact(rows)


def test_numbers_wider_than_any_decimal_add_up_alike_in_both_plans(spark):
    rng = random.Random(4)
    rows = [(1, i, 0, rng.choice([1e300, -1e300, 1e-300, 1 / 3, 12345.678])) for i in range(500)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = result(scan_groups(df, ["g"], ["a", "b"], "v"))
    assert found == result(scan_chunks(df, "g", ["a", "b"], "v"))
    for got, want in zip(found, exact(rows), strict=True):
        assert got[-1] == pytest.approx(want[-1], rel=1e-15, abs=0)


def test_infinities_and_nan(spark):
    rows = [(1, 0, 0, 2.5), (1, 1, 0, float("nan")), (1, 2, 0, float("inf")), (1, 3, 0, 1.0), (1, 4, 0, -float("inf"))]
    rows += [(2, 0, 0, -float("inf")), (2, 1, 0, 3.0)]
    inf = float("inf")
    want = [(1, 2.5), (1, 2.5), (1, inf), (1, inf), (1, None), (2, -inf), (2, -inf)]
    df = spark.createDataFrame(rows, SCHEMA)
    for found in (scan_groups(df, ["g"], ["a"], "v"), scan_chunks(df, "g", ["a"], "v")):
        assert [(r.g, r.total_after) for r in found.orderBy("g", "a").collect()] == want


def test_scale_is_as_narrow_as_the_numbers(spark):
    def parts(*numbers):
        scale = scale_of(spark.createDataFrame([(x,) for x in numbers], "v double"), "v")
        return scale.decimals, scale.parts

    assert parts(1.0, 50.0) == (0, 1) and parts(None) == (0, 1) and parts(0.1, 2.25) == (6, 1)
    assert parts(2.0**-9, 1e9) == (None, 1) and parts(1 / 3, 7.0) == (None, 1) and parts(1e13, 1 / 3) == (None, 2)


def test_one_group_of_copies_is_cut_into_chunks(spark):
    copies = spark.range(40_000).selectExpr("1L g", "1 a", "1 b", "1D v").repartition(4)
    scanned = scan_chunks(copies, "g", ["a", "b", "v"], "v")
    seen = scanned.selectExpr("count(*) n", "count(DISTINCT seq) d", "min(seq) lo", "max(seq) hi",
                              "sum(CAST(total_after - seq = 1 AS INT)) ok").first()
    assert tuple(seen) == (40_000, 40_000, 0, 39_999, 40_000)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.integers(0, 3),
            st.one_of(st.none(), st.integers(0, 3)),
            st.integers(0, 2),
            st.one_of(st.none(), st.integers(-9, 9).map(float)),
        ),
        min_size=1,
        max_size=40,
    )
)
def test_both_plans_agree_with_python(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    assert result(scan_groups(df, ["g"], ["a", "b", "v"], "v")) == expected(rows)
    assert result(scan_chunks(df, "g", ["a", "b", "v"], "v")) == expected(rows)


def test_key_offsets(spark):
    rng = random.Random(5)
    keys = set(rng.sample(range(5_000), 300))
    keys |= {rng.randrange(-(2**63), 2**63) for _ in range(200)}
    keys |= {2**22 - 1, 2**22, 2**44 - 1, 2**44, -1, 0, 2**63 - 1, -(2**63)}
    keys = sorted(keys)
    counts = [rng.randrange(1, 9) for _ in keys]
    df = spark.createDataFrame(list(zip(keys, counts)), "k long, n long").repartition(3)
    found = {r.k: r.offset for r in key_offsets(df, "k", "n").collect()}
    assert found == dict(zip(keys, [0, *accumulate(counts)][:-1]))


def keys_of(hot):
    return sorted(r[0] for r in hot.collect())


def test_hot_keys_are_the_large_groups(spark):
    df = spark.createDataFrame([(k,) for k in range(1, 8) for _ in range(k * 10)] + [(None,)] * 500, "k long")
    assert keys_of(find_hot_keys(df, SkewPolicy(max_group_rows=45))) == [5, 6, 7]
    assert find_hot_keys(df, SkewPolicy()) is None


def test_any_number_of_hot_keys_is_split(spark):
    rows = spark.range(24_000).selectExpr("id % 12000 AS g", "CAST(id DIV 12000 AS INT) a", "1 b", "1D v")
    hot = find_hot_keys(rows.select("g"), SkewPolicy(max_group_rows=1))
    assert hot.count() == 12_000
    ordinary, large = split_hot(rows, "g", hot)
    assert (ordinary.count(), large.count()) == (0, 24_000)
    assert scan(rows, "g", ["a"], "v", hot).where("total_after = a + 1 AND seq = a").count() == 24_000


def test_hot_keys_from_a_sample(spark):
    df = spark.range(60_000).selectExpr("IF(id % 3 = 0, 1L, id) AS k")
    assert keys_of(find_hot_keys(df, SkewPolicy(max_group_rows=10_000, sample_fraction=0.5))) == [1]


def test_partitions_follow_the_rows(spark, monkeypatch):
    """More rows than the session's partitions should hold go to more of them, and the totals stay."""
    rows = [(i % 97, i, float(i % 5)) for i in range(2000)]
    df = spark.createDataFrame(rows, "material bigint, n bigint, quantity double")
    assert session.spread_by(df, "material", 2000) is df
    monkeypatch.setattr(session, "ROWS_PER_TASK", 100)
    spread = session.spread_by(df, "material", 2000)
    assert spread.rdd.getNumPartitions() == 20
    plain, parted = (scan_groups(d, ["material"], ["n"], "quantity").select("material", "n", "total_after") for d in (df, spread))
    assert sorted(plain.collect()) == sorted(parted.collect())
    plan = parted._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [material" in plan
