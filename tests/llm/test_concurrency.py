"""The sweep of open sales against a scan by hand, with blocks and fans so small that every level of the tree works."""

import datetime
import itertools
import random

import pytest
from pyspark.sql import functions as F

from marlstone.llm import concurrency

SALES = "sale_id long, client_id long, total double, sold_at timestamp_ntz, n long, block long, left string"
LINES = "sale_id long, shipped_at timestamp_ntz, cents long"
CLIENTS = "client_id long, nation_id int, kids string"
START = datetime.datetime(2024, 1, 1)


def by_hand(sales, lines, clients):
    nation, first = {}, {}
    for client, own, _ in clients:
        if client is not None and own is not None:
            nation[client] = min(own, nation.get(client, own))
    for sale, at, _ in lines:
        if sale is not None and at is not None:
            first[sale] = min(at, first.get(sale, at))
    second = lambda at: int((at - datetime.datetime(1970, 1, 1)).total_seconds()) // 60 * 60
    moves = {}
    for sale, client, total, sold, *_ in sales:
        if sold is None:
            continue
        begin, end = second(sold), second(first[sale]) + 7 * 86_400 if sale in first else None
        if end is not None and end <= begin:
            continue
        cents = 0 if total is None or total != total or abs(total) == float("inf") else int((100 * total + 0.5) // 1)
        for own in (nation.get(client, -1), -2):
            for at, sign in ((begin, 1), (end, -1)):
                if at is not None:
                    n, c = moves.get((own, at), (0, 0))
                    moves[own, at] = n + sign, c + sign * cents
    rows = []
    for own, group in itertools.groupby(sorted(k for k, v in moves.items() if v != (0, 0)), lambda k: k[0]):
        at = [k[1] for k in group]
        sums = list(itertools.accumulate((moves[own, t] for t in at), lambda a, b: (a[0] + b[0], a[1] + b[1])))
        high, most = itertools.accumulate((n for n, _ in sums), max), max(c for _, c in sums)
        rows += [(own, t, nxt, n, c, h, c == most) for t, nxt, (n, c), h in zip(at, [*at[1:], None], sums, high)]
    return sorted(rows, key=str)


def made(seed, n):
    rng = random.Random(seed)
    moment = lambda days: START + datetime.timedelta(minutes=rng.randint(0, 1440 * days), seconds=rng.randint(0, 59))
    odd = [None, float("nan"), float("inf"), 0.0, 0.005, 1.115]
    sales = [(rng.choice([i, i, i, 7, None]), rng.choice([1, 1, 1, rng.randint(2, 40), None]), rng.choice([rng.random() * 100, rng.choice(odd)]), rng.choice([moment(9), moment(9), None, START]), 5, 6, "own") for i in range(n)]
    lines = [(rng.choice([rng.randint(0, n), 3, None]), rng.choice([moment(9), START - datetime.timedelta(days=8), None]), 9) for _ in range(n)]
    clients = [(rng.choice([rng.randint(0, 30), None, 1]), rng.choice([rng.randint(0, 5), None]), "own") for _ in range(40)]
    return sales, lines, clients


def run(spark, sales, lines, clients, **sizes):
    frames = [spark.createDataFrame(rows, kind) for rows, kind in ((sales, SALES), (lines, LINES), (clients, CLIENTS))]
    return sorted((tuple(r) for r in concurrency.peak_concurrency(*frames, **sizes).collect()), key=str)


@pytest.mark.parametrize("seed, n, block_rows, fan", [(1, 30, 1, 4), (2, 400, 30, 5), (3, 200, 4096, 32)])
def test_sweep_by_hand(spark, seed, n, block_rows, fan):
    tables = made(seed, n)
    assert run(spark, *tables, block_rows=block_rows, fan=fan) == by_hand(*tables)


def test_nothing_ties_and_one_sale(spark):
    assert run(spark, [], [], []) == []
    sold = START + datetime.timedelta(seconds=59)
    one = [(1, 1, 2.345, sold, 0, 0, "")]
    assert run(spark, one, [], []) == by_hand(one, [], [])
    # one sale ends as an equal one starts: nothing changes then
    later = START + datetime.timedelta(days=7)
    two = [*one, (2, 1, 2.345, later, 0, 0, "")]
    rows = run(spark, two, [(1, START, 0)], [(1, 4, "")])
    assert rows == by_hand(two, [(1, START, 0)], [(1, 4, "")]) and [r[2] for r in rows] == [None, None]


def test_joining_summaries_is_associative(spark):
    """Any bracketing of the same rows gives the same summary."""
    rows = [(i, i // 3 % 2, i, (i * 7) % 5 - 2, (i * 11) % 7 - 3) for i in range(12)]
    one = spark.createDataFrame(rows, "block long, nation_id int, at long, n long, cents long")
    part = one.select("block", F.lit(0).alias("part"), F.col("block").alias("chunk"), "nation_id", "at", "n", "cents")
    level = concurrency._block_summaries(concurrency._prefixes(part))
    tops = []
    for fan in (3, 12):
        now, top = level, 12
        while top > 1:
            now, top = concurrency._up(now, fan).select("block", "summary"), -(-top // fan)
        tops.append(now.first().summary)
    assert tops[0] == tops[1]


def test_zones(spark):
    own = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        at = spark.sql("SELECT timestamp_ntz'2024-03-10 02:30:59' AS bare, timestamp'1969-12-31 23:59:01Z' AS zoned")
        got = at.select(concurrency.minute_of(at, "bare"), concurrency.minute_of(at, "zoned")).first()
        assert tuple(got) == (1_710_037_800, -60)
    finally:
        spark.conf.set("spark.sql.session.timeZone", own)
