"""Outage alerts on a known sequence, in one go and continued."""

import datetime as dt
import random

import pytest

from studiolens.operators import alerts

# One sample a minute; alerts are due at samples 1, 7, 9 and 10.
KNOWN = [0, 1, 0, 1, 0, 1, 1, 1, 1, 0, 0, 0]
SCHEMA = "target bigint, ts timestamp_ntz, event_id bigint, down int"
START = dt.datetime(2024, 1, 1, 23, 55)


def samples(spark, downs, target=1, first=0):
    rows = [
        (target, START + dt.timedelta(minutes=first + i), first + i + 1, d)
        for i, d in enumerate(downs)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def loop(downs):
    """The rule, sample by sample."""
    run, out = 0, []
    for i, down in enumerate(downs):
        ended, run = run, run + 1 if down else 0
        if (down and run % 2 == 0) or (not down and ended >= 2) or i == 0:
            out.append(i + 1)
    return out


def test_known_sequence(spark):
    got = alerts.outage_alerts(samples(spark, KNOWN)).orderBy("event_id").collect()
    assert [r.event_id for r in got] == [1, 7, 9, 10]
    assert [r.reason for r in got] == ["first", "down", "down", "recovered"]
    assert [r.downcount for r in got] == [0, 2, 4, 0]


@pytest.mark.parametrize("limit", [1_000_000, 1])
@pytest.mark.parametrize("cut", [1, 7, 8, 9, 10])
def test_continued_from_stored_state(spark, cut, limit):
    one = alerts.probe_states(samples(spark, KNOWN[:cut]))
    state = alerts.last_state(one)
    two = alerts.probe_states(samples(spark, KNOWN[cut:], first=cut), state, limit)
    got = [r.event_id for r in one.unionByName(two).where("alert").collect()]
    assert sorted(got) == [1, 7, 9, 10]


@pytest.mark.parametrize("limit", [1_000_000, 50])
def test_random_sequences_of_several_targets(spark, limit):
    rng = random.Random(7)
    downs = {t: [int(rng.random() < 0.6) for _ in range(300)] for t in (1, 2)}
    both = samples(spark, downs[1], 1).unionByName(samples(spark, downs[2], 2))
    got = alerts.probe_states(both, task_rows=limit).where("alert").collect()
    for target, seq in downs.items():
        assert sorted(r.event_id for r in got if r.target == target) == loop(seq)


def test_an_outage_without_end(spark):
    got = alerts.probe_states(samples(spark, [1] * 200), task_rows=9).where("alert").collect()
    assert sorted(r.event_id for r in got) == [1, *range(2, 201, 2)]
