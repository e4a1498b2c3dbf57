"""The book operators against a plain loop."""

import random

import pytest
from events import SECOND, T0, normalized

from tickloom.operators import book

WIDTH = 5 * SECOND


def loop(rows):
    """Level sizes after each event, tops per bucket, and the final book."""
    books, sizes, tops = {}, {}, {}
    for i, r in enumerate(rows):
        levels = books.setdefault(r["contract_id"], {})
        sign = {"B": 1, "S": -1}.get(r["side"], 0)
        key = (sign, r["price"])
        if sign and r["action"] == "A":
            levels[key] = levels.get(key, 0) + r["size"]
        elif sign and r["action"] == "C" and key in levels:
            levels[key] = max(0, levels[key] - r["size"])
            if levels[key] == 0:
                del levels[key]
        if sign and r["action"] in "AC":
            sizes[i] = levels.get(key, 0)
        bids = [p for s, p in levels if s == 1]
        asks = [p for s, p in levels if s == -1]
        bucket = r["event_time"] // WIDTH * WIDTH
        tops[r["contract_id"], bucket] = (max(bids, default=None), min(asks, default=None))
    return sizes, tops, books


def random_rows(seed, n, *, prices=4, hot=False):
    rng = random.Random(seed)
    time, rows = T0, []
    for _ in range(n):
        time += rng.choice([0, 1, SECOND // 3, 4 * SECOND, 400 * SECOND])
        rows.append(
            {
                "event_time": time,
                "contract_id": "C1" if hot or rng.random() < 0.6 else "C2",
                "action": rng.choice("AACCCTM"),
                "side": "B" if hot else rng.choice("BSN"),
                "price": 100.0 if hot else rng.randrange(prices) + 100.0,
                "size": rng.randrange(1, 6),
            }
        )
    return rows


CASES = [
    random_rows(1, 300),
    random_rows(2, 300, prices=40),
    random_rows(3, 400, hot=True),
    # Cancel of an absent level, over-cancel, then an add: the floor holds.
    [{"event_time": T0 + i, "contract_id": "C1", "action": a, "side": "B", "price": 1.0, "size": s}
     for i, (a, s) in enumerate([("C", 5), ("A", 3), ("C", 9), ("A", 2)])],
]


@pytest.mark.parametrize("piece_s", [5, 900, 10**6])
@pytest.mark.parametrize("case", range(len(CASES)))
def test_book_equals_loop(spark, case, piece_s):
    rows = CASES[case]
    sizes, tops, books = loop(rows)
    df = normalized(spark, rows)
    piece_ns = piece_s * SECOND
    found = book.book_levels(df, piece_ns=piece_ns).collect()
    assert {r["sequence"]: r["level_size"] for r in found} == sizes
    found = book.book_top(df, piece_ns=piece_ns).collect()
    assert {(r["contract_id"], r["bucket_ns"]): (r["best_bid"], r["best_ask"]) for r in found} == tops
    found = book.book_snapshot(df, piece_ns=piece_ns).collect()
    assert {(r["contract_id"], r["side_sign"], r["price"]): r["level_size"] for r in found} == {
        (c, *k): v for c, levels in books.items() for k, v in levels.items()
    }


def test_snapshot_at_a_time(spark):
    rows = CASES[0]
    at = rows[150]["event_time"]
    _, _, books = loop([r for r in rows if r["event_time"] <= at])
    found = book.book_snapshot(normalized(spark, rows), at_ns=at).collect()
    assert {(r["contract_id"], r["side_sign"], r["price"]): r["level_size"] for r in found} == {
        (c, *k): v for c, levels in books.items() for k, v in levels.items()
    }


def test_top_over_a_long_quiet_level(spark):
    """A level set once still is the best after many buckets, and none is lost in between."""
    rows = [{"event_time": T0, "price": 50.0}]
    rows += [{"event_time": T0 + i * WIDTH, "action": "T", "side": "N"} for i in range(1, 2000)]
    found = book.book_top(normalized(spark, rows)).collect()
    assert len(found) == 2000 and {r["best_bid"] for r in found} == {50.0}


def test_times_around_the_epoch(spark):
    rows = [{**r, "event_time": r["event_time"] - CASES[1][150]["event_time"]} for r in CASES[1]]
    _, tops, _ = loop(rows)
    found = book.book_top(normalized(spark, rows)).collect()
    assert {(r["contract_id"], r["bucket_ns"]): (r["best_bid"], r["best_ask"]) for r in found} == tops


def test_buckets_longer_than_a_piece(spark):
    rows = CASES[0]
    hour = 3600 * SECOND
    found = book.book_top(normalized(spark, rows), hour).collect()
    _, tops, _ = loop(rows)
    last = {}
    for (contract, bucket), top in sorted(tops.items()):
        last[contract, bucket // hour * hour] = top
    assert {(r["contract_id"], r["bucket_ns"]): (r["best_bid"], r["best_ask"]) for r in found} == last


def test_pieces_must_hold_whole_buckets(spark):
    with pytest.raises(ValueError, match="multiple"):
        book.level_closes(normalized(spark, CASES[3]), WIDTH, piece_ns=WIDTH + 1)


def test_trade_stats(spark):
    trades = [(0, 10.0, 2), (1, 11.0, 3), (5 * SECOND, 12.0, 4)]
    rows = [{"event_time": T0 + t, "action": "T", "side": "N", "price": p, "size": s}
            for t, p, s in trades]
    found = book.trade_stats(normalized(spark, rows)).orderBy("bucket_ns").collect()
    assert [tuple(r)[2:] for r in found] == [(11.0, 3, 5), (12.0, 4, 9)]


def test_level_deltas_skip_trades_and_unknown_sides(spark):
    rows = [{"size": 2}, {"size": 3}, {"action": "c", "size": 1}, {"action": "T"}, {"side": "N"}]
    found = book.level_deltas(normalized(spark, rows)).collect()
    assert {(r["action"], r["size_sum"]) for r in found} == {("A", 5), ("C", 1)}
