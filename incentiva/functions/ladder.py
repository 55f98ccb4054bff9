"""Step-ladder column functions.

A ladder is an ascending list of (share threshold, unit rate). For a share:

* unit rate: the rate of the highest threshold <= share, else 0
* payout: graduates x unit rate
* next target: the lowest threshold > share; the top text ('max') at or above the
  top rung; a null share gets the lowest threshold
* next target in stores: ``ceil(portfolio x next target)``; the top text at the top;
  a null portfolio gives null

Each is one ``CASE`` chain generated from the ladder, so it stays JVM-side. The
thresholds are decimal literals: ``ceil(100 x 0.07)`` is 7, not the 8 a double gives.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import Ladder


def _dec(x) -> Column:
    return F.lit(x)


def unit_rate(share: Column, ladder: Ladder) -> Column:
    out = None
    for rung in reversed(ladder.rungs):
        cond = share >= _dec(rung.threshold)
        out = F.when(cond, F.lit(rung.rate)) if out is None else out.when(cond, F.lit(rung.rate))
    return out.otherwise(F.lit(0)).cast("int")


def payout(graduates: Column, share: Column, ladder: Ladder) -> Column:
    g = graduates.cast("bigint")
    out = None
    for rung in reversed(ladder.rungs):
        cond = share >= _dec(rung.threshold)
        val = g * F.lit(rung.rate)
        out = F.when(cond, val) if out is None else out.when(cond, val)
    return out.otherwise(F.lit(0)).cast("bigint")


def _next_chain(share: Column, ladder: Ladder, branch, top_text: str) -> Column:
    """CASE chain: top text at the top, ``branch(next threshold)`` in each band,
    ``branch(lowest)`` otherwise (below the lowest rung or a null share)."""
    rungs = ladder.rungs
    out = F.when(share >= _dec(ladder.top.threshold), F.lit(top_text))
    for lower, upper in reversed(list(zip(rungs[:-1], rungs[1:]))):
        out = out.when(share >= _dec(lower.threshold), branch(upper))
    return out.otherwise(branch(ladder.lowest))


def next_target(share: Column, ladder: Ladder, top_text: str = "max") -> Column:
    """Next share target as text ('0.25'), or ``top_text`` at the top."""
    return _next_chain(share, ladder, lambda r: F.lit(str(r.threshold)), top_text)


def next_target_count(size: Column, share: Column, ladder: Ladder, top_text: str = "max") -> Column:
    """Stores needed for the next target, ``ceil(size x threshold)``, as text."""
    return _next_chain(
        share, ladder, lambda r: F.ceil(size * _dec(r.threshold)).cast("string"), top_text
    )


def next_target_share(share: Column, ladder: Ladder) -> Column:
    """Typed form of ``next_target``: a decimal, null at the top of the ladder."""
    rungs = ladder.rungs
    out = F.when(share >= _dec(ladder.top.threshold), F.lit(None))
    for lower, upper in reversed(list(zip(rungs[:-1], rungs[1:]))):
        out = out.when(share >= _dec(lower.threshold), _dec(upper.threshold))
    return out.otherwise(_dec(ladder.lowest.threshold))
