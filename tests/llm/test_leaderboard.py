"""The change feed against a plain replay of the contract, with shards and levels of merging forced small."""

import datetime
import random
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest

from leksika.llm import leaderboard

LINES = "sale_id long, line_no int, item_id long, vendor_id long, quantity int, amount double, discount double, flag string, shipped_at timestamp_ntz, owner string, batch string"
START = datetime.datetime(2024, 1, 1)


def replay(lines, nations, prices):
    """The feed by dictionaries: every line in order of batch and day."""
    rows = []
    for sale, line, item, vendor, quantity, amount, _, flag, shipped, *_ in lines:
        h = zlib.crc32(",".join("" if x is None else str(x) for x in (sale, item, vendor, line)).encode())
        s = 19723 + h % 150 if shipped is None else (shipped.date() - datetime.date(1970, 1, 1)).days
        a = s + h % 7 + 20 * (h % 5 == 0)
        cents = int(np.floor(100 * amount + 0.5)) if amount is not None else quantity * int(np.floor(100 * prices[item] + 0.5)) if quantity is not None and prices.get(item) is not None else 0
        rows.append((min(10, 1 + (a - 19723) * 10 // 180), a, s, nations.get(vendor), item, -cents if flag == "swapped" else cents))
    out, boards, totals = [], {}, defaultdict(lambda: defaultdict(int))
    newest = None
    for batch in sorted({r[0] for r in rows}):
        mine = [r for r in rows if r[0] == batch]
        kept = [r for r in mine if (newest is None or r[2] + 3 >= newest) and r[3] is not None and r[4] in prices]
        for day in sorted({r[1] for r in kept}):
            for nation in sorted({r[3] for r in kept if r[1] == day}):
                for r in kept:
                    if r[1] == day and r[3] == nation:
                        totals[nation][r[4]] += r[5]
                board = [i for i, c in sorted(totals[nation].items(), key=lambda x: (-x[1], x[0])) if c > 0][:10]
                before = boards.get(nation, [])
                for i in {*board, *before}:
                    old, new = (b.index(i) + 1 if i in b else None for b in (before, board))
                    if old != new:
                        out.append((nation, day, i, batch, "enter" if old is None else "exit" if new is None else "move", old, new, totals[nation][i]))
                boards[nation] = board
        newest = max([r[2] for r in mine] + ([newest] if newest is not None else []))
    return sorted(out, key=repr)


def made(seed, n=700):
    rng = random.Random(seed)
    lines = []
    for k in range(n):
        hot = rng.random() < 0.33
        lines.append((
            rng.choice((None, 1, rng.randrange(200))), rng.choice((None, 1, 2, 3)), 7 if hot else rng.choice((None, 999, *range(40))), 0 if hot else rng.choice((None, 99, *range(6))),
            rng.choice((None, 1, 5)), rng.choice((None, 0.0, 1.005, 10.0, 10.0, round(rng.uniform(0, 50), 2))), 0.0, rng.choice(("kept", "kept", "swapped", None)),
            rng.choice((None, START + datetime.timedelta(days=rng.randrange(149), hours=rng.randrange(24)))), "x", "y",
        ))
    return lines + lines[:20]  # repeated rows count each


NATIONS, PRICES = {0: 1, 1: 1, 2: 2, 3: 3, 4: None, 5: 1}, {**{i: 2.5 + i for i in range(40)}, 5: None}


def tables(spark, lines):
    vendors = spark.createDataFrame([(k, v, "x") for k, v in NATIONS.items()] + [(None, 4, "x"), (0, 1, "again")], "vendor_id long, nation_id int, item_id string")
    items = spark.createDataFrame([(k, v, 3) for k, v in PRICES.items()] + [(None, 1.0, 3), (7, PRICES[7], 4)], "item_id long, price double, day int")
    return spark.createDataFrame(lines, LINES), vendors, items


def found(df):
    names = [c.split()[0] for c in leaderboard.FEED.split(", ")]
    assert df.columns == names
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_feed_is_that_of_a_plain_replay(spark, monkeypatch):
    """Shards of 16 lines, merged four at a time on three levels, one owner and item with a third of all lines."""
    monkeypatch.setattr(leaderboard, "LINES", 16)
    monkeypatch.setattr(leaderboard, "FAN", 4)
    lines = made(1)
    expected = replay(lines, NATIONS, PRICES)
    assert found(leaderboard.change_feed(*tables(spark, lines))) == expected
    assert {r[4] for r in expected} == {"enter", "exit", "move"} and len(expected) > 200
    assert all(spark.conf.get(k, "unset") != v for k, v in leaderboard.STATE.items() if k.endswith(("providerClass", "allowFAllocate")))


def test_empty_and_all_ignored(spark):
    none, vendors, items = tables(spark, [])
    assert found(leaderboard.change_feed(none, vendors, items)) == []
    ignored, *_ = tables(spark, [(1, 1, 999, 0, 1, 1.0, 0.0, "kept", START, "x", "y"), (1, 1, 3, 4, 1, 1.0, 0.0, "kept", START, "x", "y")])
    assert found(leaderboard.change_feed(ignored, vendors, items)) == []


class Kept(dict):
    getValue, updateValue, removeKey = dict.get, dict.__setitem__, dict.__delitem__


@pytest.mark.parametrize("seed", range(5))
def test_ladder_holds_its_state(seed):
    """After any batches, bands are those of the revenues and the last board is the ten highest."""
    rng = np.random.default_rng(seed)
    ladder, total, last = leaderboard.Ladder(), defaultdict(int), []
    ladder.bands, ladder.revenues = Kept(), Kept()
    for batch in range(6):
        n = int(rng.integers(1, 60))
        rows = pd.DataFrame({"day": batch * 10 + rng.integers(0, 9, n), "item_id": rng.integers(0, 80, n), "cents": rng.integers(-300, 500, n) * 10 ** rng.integers(0, 5, n)})
        for out in ladder.handleInputRows((1, 0), iter([rows.iloc[: n // 2], rows.iloc[n // 2 :]]), None):
            last = list(zip(out["items"].iloc[-1], out["cents"].iloc[-1], strict=True))
        for i, c in zip(rows.item_id, rows.cents, strict=True):
            total[int(i)] += int(c)
        assert last == leaderboard.first_of([i for i, c in total.items() if c > 0], [c for c in total.values() if c > 0])
        assert {int(i) for v in ladder.bands.values() for i in np.frombuffer(v[0], np.int64)} == {i for i, c in total.items() if c > 0}
        for (band,), (ids,) in ladder.bands.items():
            assert {int(b) for b in leaderboard.bands_of(np.array([total[int(i)] for i in np.frombuffer(ids, np.int64)]))} == {band}
        assert {int(i): int(c) for ids, cents in ladder.revenues.values() for i, c in zip(np.frombuffer(ids, np.int64), np.frombuffer(cents, np.int64), strict=True)} == total


def test_bands_rise_with_revenue():
    cents = np.array([-5, 0, *range(1, 5000), *(3 << k for k in range(11, 60))])
    assert (np.diff(leaderboard.bands_of(cents)) >= 0).all() and leaderboard.bands_of(cents)[:2].tolist() == [0, 0]
    assert len(set(leaderboard.bands_of(np.array([1 << k for k in range(62)])).tolist())) == 62
