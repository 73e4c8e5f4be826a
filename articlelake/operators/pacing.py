"""When requests may start: a distance between starts, and a bucket of tokens that fills up again."""

import time
from collections.abc import Callable
from dataclasses import dataclass


def words(text: str) -> int:
    return len(text.split())


@dataclass(frozen=True)
class Pace:
    """The limits of an endpoint, shared out evenly over `parallel` tasks.

    `count` says how many tokens a text has: the model's own count, where it is at hand.
    """

    requests_per_minute: float | None = None
    tokens_per_minute: float | None = None
    parallel: int = 1
    count: Callable[[str], int] = words

    def limiter(
        self,
        clock: Callable[[], float],
        sleep: Callable[[float], None],
        running: bool = False,
        state: "State | None" = None,
    ) -> "Limiter":
        limiter = Limiter(self, clock, sleep, running)
        if state is not None:
            limiter.state = state
        return limiter


@dataclass(frozen=True)
class State:
    """What a limiter knows between two requests: tokens left, since when, and the last start."""

    level: float
    filled: float
    last: float | None


class Limiter:
    """One task's share. `running` says that requests were made just before: the bucket starts empty."""

    def __init__(self, pace: Pace, clock: Callable[[], float], sleep: Callable[[float], None], running: bool):
        self._pace, self._clock, self._sleep = pace, clock, sleep
        rpm, tpm = pace.requests_per_minute, pace.tokens_per_minute
        self._interval = 60.0 * pace.parallel / rpm if rpm else 0.0
        self._rate = tpm / 60.0 / pace.parallel if tpm else None
        self._room = tpm / pace.parallel if tpm else 0.0
        self._level = 0.0 if running else self._room
        self._filled = clock()
        self._last = self._filled if running else None

    @property
    def state(self) -> State:
        return State(self._level, self._filled, self._last)

    @state.setter
    def state(self, known: State) -> None:
        self._level, self._filled, self._last = known.level, known.filled, known.last

    def start(self, texts: list[str]) -> None:
        """Wait until a request of these texts may start."""
        self.take(sum(map(self._pace.count, texts)) if self._rate is not None else 0)

    def take(self, tokens: int) -> None:
        """Wait until a request of so many tokens may start.

        One of more tokens than the bucket holds starts when it is full, and those after it
        wait for what it took beyond that.
        """
        early = 0.0
        if self._interval and self._last is not None:
            early = self._interval - (self._clock() - self._last)
        if self._rate is not None:
            self._fill()
            early = max(early, (min(tokens, self._room) - self._level) / self._rate)
        if early > 0:
            self._sleep(early)
        if self._rate is not None:
            self._fill()
            self._level -= tokens
        self._last = self._clock()

    def _fill(self) -> None:
        now = self._clock()
        self._level = min(self._room, self._level + self._rate * (now - self._filled))
        self._filled = now
