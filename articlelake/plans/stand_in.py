"""Models for the registered queries and the tests, which test the jobs and not a model."""


def hashed_vectors(size: int):
    """Bytes of the text's MD5, scaled to [-1, 1).

    Returns a factory, as a real client would be: it is called once per task.
    """

    def connect():
        import hashlib

        def embed(texts):
            digests = (hashlib.md5(t.encode("utf-8")).digest() for t in texts)
            return [[(d[i % 16] - 128) / 128 for i in range(size)] for d in digests]

        return embed

    return connect


class Endpoint:
    """A client with a clock of its own: a request takes `seconds`, and the n-th fails `failures(n)` times first.

    The vector of each text tells of its request: number, attempts, seconds waited since the
    request was first made, the minute and millisecond of its last start, texts and tokens.
    `since()` tells the request and the time that a task begins with, both 0 otherwise.
    """

    def __init__(self, seconds: float = 0.0, failures=lambda n: 0, count=len, since=lambda: (0, 0.0)):
        self.now, self.seconds, self.failures, self.count, self.since = 0.0, seconds, failures, count, since

    def clock(self) -> float:
        return self.now

    def sleep(self, seconds: float) -> None:
        self.now += seconds

    def connect(self):
        first, self.now = self.since()
        state = {"request": first, "attempt": 0, "first": 0.0}

        def embed(texts):
            if not state["attempt"]:
                state["first"] = self.now
            state["attempt"] += 1
            if state["attempt"] <= self.failures(state["request"]):
                raise ConnectionError("busy")
            minute, second = divmod(self.now, 60)
            told = [state["request"], state["attempt"], self.now - state["first"], minute, second * 1000 // 1]
            told += [len(texts), sum(map(self.count, texts))]
            state["request"], state["attempt"] = state["request"] + 1, 0
            self.now += self.seconds
            return [[float(x) for x in told]] * len(texts)

        return embed
