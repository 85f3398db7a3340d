"""Global windows in blocks against plain windows."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import final_plan, rows
from tallyhouse.operators.concentration import bucket_share, long_tail, pareto_head
from tallyhouse.operators.ladder import (
    climb, prefix_totals, tile_sums, value_groups, with_dense_rank, with_order_key, with_tile,
)
from tallyhouse.operators.ranking import top_k_with_ties

quick = settings(
    max_examples=6,
    deadline=None,
    phases=[Phase.generate],
    suppress_health_check=list(HealthCheck),
)


def hot_values(n: int = 600, seed: int = 1):
    """(id, value): a third of the rows share one value, a few are far out."""
    draw = random.Random(seed)
    values = [500] * (n // 3) + [draw.randrange(0, 2000) for _ in range(n - n // 3 - 3)]
    values += [10**15, 10**12, 0]
    draw.shuffle(values)
    return [(i + 1, v) for i, v in enumerate(values)]


def tiles_by_hand(values, n):
    """ntile over the values from the highest."""
    ordered = sorted(values, reverse=True)
    size, extra = divmod(len(ordered), n)
    sums, at = {}, 0
    for tile in range(1, n + 1):
        count = size + (tile <= extra)
        if count:
            sums[tile] = (count, sum(ordered[at:at + count]))
        at += count
    return sums


@quick
@given(
    keys=st.sets(st.integers(-(2**62), 2**62) | st.integers(-50, 50), min_size=1, max_size=60),
    bits=st.sampled_from([1, 3, 21]),
    levels=st.sampled_from([0, 1, 2, 3]),
)
def test_prefix_totals_for_any_block_size(spark, keys, bits, levels):
    keys = sorted(keys)
    frame = spark.createDataFrame([(k, i + 1) for i, k in enumerate(keys)], "k long, m long")
    got = dict(rows(prefix_totals(frame, "k", ["m"], bits=bits, levels=levels).select("k", "before_m")))
    assert got == {k: i * (i + 1) // 2 for i, k in enumerate(keys)}


def test_prefix_totals_within_groups(spark):
    data = [(g, k, 1) for g in (1, 2) for k in range(g, 40, g)]
    frame = spark.createDataFrame(data, "g long, k long, m long")
    got = rows(prefix_totals(frame, "k", ["m"], ["g"], bits=2, levels=2).select("g", "k", "before_m"))
    assert {(g, k): b for g, k, b in got} == {(g, k): (k // g) - 1 for g, k, _ in data}


@pytest.mark.parametrize("descending", [True, False])
def test_climb_equals_plain_windows(spark, descending):
    frame = spark.createDataFrame(hot_values(), "id long, v long")
    order = F.desc("v") if descending else F.asc("v")
    plain = frame.select(
        "v",
        F.rank().over(Window.orderBy(order)).cast("long"),
        F.dense_rank().over(Window.orderBy(order)).cast("long"),
        F.sum("v").over(Window.orderBy(order)),
    ).distinct()
    ladder = climb(value_groups(with_order_key(frame, "v"), "_key"), "_key", (), descending).select(
        "_key",
        F.col("before_rows") + 1,
        F.col("before_steps") + 1,
        F.col("before_total") + F.col("total"),
    )
    assert sorted(rows(ladder)) == sorted(rows(plain))


@pytest.mark.parametrize("n", [3, 10, 23, 600])
@pytest.mark.parametrize("tiles", [3, 10])
def test_tiles(spark, n, tiles):
    data = hot_values(n) if n > 10 else [(i, v) for i, v in enumerate([7, 7, 1, 7, 5, 5, 0, 2, 3, 7][:n])]
    frame = spark.createDataFrame(data, "id long, v long")
    sums = {t: (r, s) for t, r, s in rows(tile_sums(frame, "v", tiles).select("tile", "rows", "total"))}
    assert sums == tiles_by_hand([v for _, v in data], tiles)

    window = Window.orderBy(F.desc("v"), "id")
    plain = frame.select(
        "id", F.row_number().over(window).cast("long"), F.ntile(tiles).over(window).cast("long")
    )
    placed = with_tile(frame, "v", "id", tiles).select("id", "position", "tile")
    assert sorted(rows(placed)) == sorted(rows(plain))


def test_dense_rank_within_groups(spark):
    data = [(g, i, v) for g in (1, 2, 3) for i, v in hot_values(90, seed=g)]
    frame = spark.createDataFrame(data, "g long, id long, v long")
    window = Window.partitionBy("g").orderBy(F.desc("v"))
    plain = frame.select("g", "id", F.dense_rank().over(window).cast("long"))
    ranked = with_dense_rank(frame, "v", "r", ["g"]).select("g", "id", "r")
    assert sorted(rows(ranked)) == sorted(rows(plain))


def test_null_value_is_ranked_below_zero(spark):
    frame = spark.createDataFrame([(1, 5), (2, None), (3, 0)], "id long, v long")
    assert sorted(rows(with_dense_rank(frame, "v", "r").select("id", "r"))) == [(1, 1), (2, 3), (3, 2)]


#: Beyond 64 bits on both sides of zero, at the edges of the limbs, ties, and nulls.
WIDE = [
    10**28, 10**28, 10**28 + 1, 10**12, 10**12 - 1, 10**12 + 1, 10**18, 2**63, 2**63 - 1, 5, 5, 1, 0, 0, -1, -1, -5,
    -(10**12), -(10**12) - 1, -(10**12) + 1, -(10**18), -(2**63) - 7, -(10**28), None, None, 7 * 10**29, -(7 * 10**29),
]


def wide_frame(spark, values=WIDE, groups=1):
    data = [(g, i, None if v is None else Decimal(v)) for g in range(groups) for i, v in enumerate(values[g:])]
    return spark.createDataFrame(data, "g long, id long, v decimal(38,0)").repartition(3)


@pytest.mark.parametrize("descending", [True, False])
def test_wide_signed_values_and_nulls_rank_as_in_a_plain_window(spark, descending):
    frame = wide_frame(spark, groups=3)
    window = Window.partitionBy("g").orderBy(F.desc("v") if descending else F.asc("v"))
    plain = frame.select("g", "id", "v", F.dense_rank().over(window).cast("long"))
    ranked = with_dense_rank(frame, "v", "r", ["g"], descending).select("g", "id", "v", "r")
    order = lambda row: (row[0], row[1])
    assert sorted(rows(ranked), key=order) == sorted(rows(plain), key=order)


def test_wide_running_sums_and_tiles(spark):
    draw = random.Random(9)
    values = WIDE + [draw.randrange(-(10**25), 10**25) for _ in range(200)] + [10**24] * 50
    frame = wide_frame(spark, values)
    keyed = with_order_key(frame, "v")
    window = Window.orderBy(F.desc_nulls_last("v"))
    plain = keyed.select("_key", F.sum("v").over(window)).distinct()
    ladder = climb(value_groups(keyed, "_key"), "_key").select("_key", F.col("before_total") + F.col("total"))
    assert sorted(rows(ladder)) == sorted(rows(plain))
    sums = {t: (r, s) for t, r, s in rows(tile_sums(frame, "v", 7).select("tile", "rows", "total"))}
    by_hand = tiles_by_hand([-(10**37) if v is None else v for v in values], 7)
    assert {t: r for t, (r, _) in sums.items()} == {t: r for t, (r, _) in by_hand.items()}
    assert [sums[t][1] for t in range(1, 7)] == [by_hand[t][1] for t in range(1, 7)]
    assert sums[7][1] == by_hand[7][1] + 2 * 10**37
    order = Window.orderBy(F.desc_nulls_last("v"), "id")
    plain = frame.select("id", F.row_number().over(order).cast("long"), F.ntile(7).over(order).cast("long"))
    assert sorted(rows(with_tile(frame, "v", "id", 7).select("id", "position", "tile"))) == sorted(rows(plain))


def test_long_null_is_below_negative_values(spark):
    data = [(1, 5), (2, None), (3, -500), (4, -1), (5, None)]
    frame = spark.createDataFrame(data, "id long, v long")
    ranked = with_dense_rank(frame, "v", "r").select("id", "v", "r")
    assert sorted(rows(ranked), key=lambda r: r[0]) == [(1, 5, 1), (2, None, 4), (3, -500, 3), (4, -1, 2), (5, None, 4)]
    placed = with_tile(frame, "v", "id", 2).select("id", "position")
    assert sorted(rows(placed)) == [(1, 1), (2, 4), (3, 3), (4, 2), (5, 5)]


@quick
@given(values=st.lists(st.integers(-(10**30) + 1, 10**30 - 1) | st.integers(-(2**64), 2**64) | st.integers(-3, 3) | st.none(), min_size=1, max_size=40))
def test_wide_ranks_of_any_values(spark, values):
    got = {i: r for i, r in rows(with_dense_rank(wide_frame(spark, values), "v", "r").select("id", "r"))}
    distinct = sorted({v for v in values if v is not None}, reverse=True)
    assert got == {i: len(distinct) + 1 if v is None else distinct.index(v) + 1 for i, v in enumerate(values)}


def test_top_k_keeps_every_tie(spark):
    data = [(i, 100 - i) for i in range(9)] + [(i, 10) for i in range(9, 500)] + [(500, 1)]
    frame = spark.createDataFrame(data, "id long, v long")
    best = rows(top_k_with_ties(frame, "v", "r").select("id", "v", "r"))
    assert len(best) == 500
    assert {r for i, _, r in best if i >= 9} == {10}


@pytest.mark.parametrize("k", [1, 3, 50])
def test_top_k_within_groups(spark, k):
    draw = random.Random(k)
    data = [("hot", i, draw.choice([7, 7, 7, draw.randrange(40), None])) for i in range(400)]
    data += [(g, i, draw.choice([None, -5, -1, 0, 3])) for g in ("a", None, "") for i in range(15)]
    data += [("alone", 1, None), ("one", 1, -9)]
    frame = spark.createDataFrame(data, "g string, id long, v long").repartition(5)
    best = sorted(rows(top_k_with_ties(frame, "v", "r", k, ("g",)).select("g", "id", "v", "r")), key=str)
    wanted = []
    for g in {g for g, _, _ in data}:
        values = sorted({v for x, _, v in data if x == g}, key=lambda v: (v is None, -(v or 0)))
        wanted += [(x, i, v, values.index(v) + 1) for x, i, v in data if x == g and values.index(v) < k]
    assert best == sorted(wanted, key=str)


def test_tasks_pass_on_k_values_of_a_group(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__coalescePartitions__enabled="false")
    frame = spark.range(30_000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise("b").alias("g"), F.col("id"), (F.col("id") % 9973).alias("v"))
    text = final_plan(top_k_with_ties(frame, "v", "r", 3, ("g",)))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_pareto_leaves_out_ties_on_the_line(spark):
    # 40 + 30 = 70 %; either 15 alone would stay at 85 %, over the line
    frame = spark.createDataFrame([(1, 40), (2, 30), (3, 15), (4, 15)], "id long, v long")
    assert {i for i, in rows(pareto_head(frame, "v").select("id"))} == {1, 2}
    assert rows(long_tail(frame, "v")) == [(30.0,)]
    # exactly 80 % is inside
    frame = spark.createDataFrame([(1, 50), (2, 30), (3, 20)], "id long, v long")
    assert {i for i, in rows(pareto_head(frame, "v").select("id"))} == {1, 2}


@quick
@given(values=st.lists(st.integers(0, 10**6), min_size=1, max_size=60))
def test_head_and_tail_cover_everything(spark, values):
    frame = spark.createDataFrame(list(enumerate(values)), "id long, v long")
    total = sum(values)
    head = sum(v for v, in rows(pareto_head(frame, "v").select("v")))
    (tail,), = rows(long_tail(frame, "v"))
    if total == 0:
        assert head == 0 and tail is None
    elif head == total:
        assert tail is None
    else:
        assert abs((tail or 0) - 100 * (total - head) / total) < 0.0051


def test_bucket_shares(spark):
    frame = spark.createDataFrame([(i, 10 * (i + 1)) for i in range(10)], "id long, v long")
    bucket = F.when(F.col("tile") == 1, "top").otherwise("rest")
    got = {b: (t, s) for b, t, s in rows(bucket_share(frame, "v", 10, bucket))}
    assert got == {"top": (100, 18.18), "rest": (450, 81.82)}
