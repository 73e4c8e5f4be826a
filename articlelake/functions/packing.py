"""Greedy packing of units into overlapping windows, as one fold over their sizes.

Every passage is a contiguous run of units, because the carried overlap is a suffix of
the run before it. So the state is a window start and a token total, and the result an
array of `{first, last, tokens}` (1-based, inclusive). No shuffle and no Python.
"""

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from articlelake.functions.binding import let

WINDOW = "struct<first:int,last:int,tokens:int>"


@dataclass(frozen=True)
class Sizes:
    """Window sizes: 0 < target <= maximum and 0 <= overlap < maximum, checked as they are made."""

    target: int
    maximum: int
    overlap: int

    def __post_init__(self):
        rules = {
            "0 < target": self.target > 0,
            "target <= maximum": self.target <= self.maximum,
            "0 <= overlap": self.overlap >= 0,
            "overlap < maximum": self.overlap < self.maximum,
        }
        if broken := [rule for rule, holds in rules.items() if not holds]:
            raise ValueError(f"{self}: not {', not '.join(broken)}")


# units, tokens: the suffix taken so far; fits: whether the budget has held for all of it
_CARRIED = """
  aggregate(
    reverse(slice(sizes, t.open.first, t.last - t.open.first + 1)),
    named_struct('units', 0, 'tokens', 0, 'fits', true),
    (o, m) -> if(o.fits AND o.tokens + m <= {overlap},
                 named_struct('units', o.units + 1, 'tokens', o.tokens + m, 'fits', true),
                 named_struct('units', o.units, 'tokens', o.tokens, 'fits', false)),
    o -> named_struct('first', t.last + 1 - o.units, 'tokens', o.tokens + n))
"""
_NOTHING_CARRIED = "named_struct('first', t.last + 1, 'tokens', n)"

# t: the open window, its last unit and the windows closed in this stretch of units; n:
# the size of the next unit; s: the same between stretches, with all windows so far.
# `aggregate` copies its state at every step. Going by stretches keeps the state of the
# many steps short, so the cost of a very long article stays close to linear.
_WINDOWS = """
element_at(transform(array({sizes}), sizes ->
  aggregate(
    transform(sequence(1, greatest(array_size(sizes), 1), {stretch}),
              i -> slice(sizes, i, {stretch})),
    named_struct('open', named_struct('first', 1, 'tokens', 0), 'last', 0,
                 'blocks', cast(array() AS array<array<{window}>>)),
    (s, units) -> aggregate(
      units,
      named_struct('open', s.open, 'last', s.last, 'closed', cast(array() AS array<{window}>)),
      (t, n) -> if(
        t.last >= t.open.first
          AND (t.open.tokens + n > {maximum} OR t.open.tokens >= {target}),
        named_struct(
          'open', {carried},
          'last', t.last + 1,
          'closed', concat(t.closed, array(named_struct(
            'first', t.open.first, 'last', t.last, 'tokens', t.open.tokens)))),
        named_struct(
          'open', named_struct('first', t.open.first, 'tokens', t.open.tokens + n),
          'last', t.last + 1, 'closed', t.closed)),
      t -> named_struct('open', t.open, 'last', t.last,
                        'blocks', concat(s.blocks, array(t.closed)))),
    s -> if(s.last = 0, flatten(s.blocks), flatten(concat(s.blocks, array(array(named_struct(
      'first', s.open.first, 'last', s.last, 'tokens', s.open.tokens)))))))), 1)
"""
_STRETCH = 256


def windows(lengths: str, sizes: Sizes) -> Column:
    """Windows over an array of unit sizes, given as SQL; an empty array has none.

    The array is bound once, as a lambda would evaluate it again for every unit.
    """
    carried = _CARRIED.format(overlap=sizes.overlap) if sizes.overlap else _NOTHING_CARRIED
    return F.expr(
        _WINDOWS.format(
            sizes=lengths,
            target=sizes.target,
            maximum=sizes.maximum,
            carried=carried,
            window=WINDOW,
            stretch=_STRETCH,
        )
    )


def passages(texts: Column, spans: Column) -> Column:
    """The text of each window."""
    return let(
        texts,
        lambda t: F.transform(
            spans, lambda w: F.array_join(F.slice(t, w.first, w.last - w.first + 1), " ")
        ),
    )
