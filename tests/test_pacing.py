import pytest

from articlelake.operators.pacing import Pace
from articlelake.plans.stand_in import Endpoint


def starts(pace, sizes, seconds=0.0, running=False):
    clock = Endpoint()
    limiter, out = pace.limiter(clock.clock, clock.sleep, running), []
    for n in sizes:
        limiter.start(["x" * n])
        out.append(clock.now)
        clock.sleep(seconds)
    return out


def test_requests_keep_their_distance():
    assert starts(Pace(30), [1] * 4) == [0, 2, 4, 6]
    assert starts(Pace(30), [1] * 3, seconds=1.5) == [0, 2, 4]
    assert starts(Pace(30), [1] * 3, seconds=5) == [0, 5, 10]
    assert starts(Pace(30, parallel=3), [1] * 3) == [0, 6, 12]
    assert starts(Pace(30), [1] * 2, running=True) == [2, 4]


def test_tokens_of_any_minute_stay_within_bucket_and_refill():
    pace = Pace(tokens_per_minute=600, count=len)  # a bucket of 600, 10 a second
    assert starts(pace, [600, 100, 100]) == [0, 10, 20]
    assert starts(pace, [100] * 8) == [0, 0, 0, 0, 0, 0, 10, 20]
    assert starts(pace, [1500, 100]) == [0, 100]  # beyond the bucket: what follows waits for it
    assert starts(pace, [100], running=True) == [10]


def test_both_limits_hold():
    assert starts(Pace(60, 600, count=len), [300, 300, 100, 1]) == pytest.approx([0, 1, 8, 9])


def test_limits_are_shared():
    assert starts(Pace(None, 600, parallel=2, count=len), [300, 100]) == [0, 20]


def test_no_limit():
    assert starts(Pace(), [10**9] * 3) == [0, 0, 0]
