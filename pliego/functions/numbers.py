"""Guarded arithmetic, codes, bands and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Upper ends of the win-rate bands (closed), and the last band.
WIN_RATE_BANDS = ((0.05, "Eliminable"), (0.20, "Débil"), (0.40, "Competitivo"))
TOP_BAND = "Core"
#: What to do with a band's products.
PORTFOLIO = {"Core": "P1 Segmento Core", "Débil": "P2 Segmento Débil", "Eliminable": "P3 Segmento Eliminable", "Competitivo": "mantener"}
#: Segments of price positions, in reporting order.
SEGMENTS = ("W1 — Aligned", "W2 — Improvable", "W3 — Comp-Overshot", "W4 — Lock-In", "W5 — Monopoly", "L1 — Recoverable", "L2 — Overshot", "L3 — Lock-Out", "D — Unawarded")
#: Fixed value: the share by which two prices may differ and still be close.
TOLERANCE = 0.015


def gap(a: Column, b: Column) -> Column:
    """(a - b) / b, null where b is 0."""
    return F.try_divide(a - b, b)


def ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def product(*cs: Column) -> Column:
    """Nulls count as 0."""
    out = F.lit(1.0)
    for c in cs:
        out = out * F.coalesce(c.cast("double"), F.lit(0.0))
    return out


def close(a: Column, b: Column, tolerance: float = TOLERANCE) -> Column:
    return F.abs(a - b) <= tolerance * F.greatest(F.abs(a), F.abs(b))


def prefix_bounds(prefix: int, digits: int = 8) -> tuple[int, int]:
    """[low, high) of the codes of digits digits that start with prefix."""
    scale = 10 ** (digits - len(str(prefix)))
    return prefix * scale, (prefix + 1) * scale


def in_segment(code: Column, prefix: int | None) -> Column:
    """A range, so that it reaches the scan."""
    if prefix is None:
        return F.lit(True)
    low, high = prefix_bounds(prefix)
    return (code >= low) & (code < high)


def win_rate_band(rate: Column) -> Column:
    out = F.when(rate <= WIN_RATE_BANDS[0][0], WIN_RATE_BANDS[0][1])
    for end, name in WIN_RATE_BANDS[1:]:
        out = out.when(rate <= end, name)
    return F.when(rate.isNotNull(), out.otherwise(TOP_BAND))


def portfolio_label(band: Column) -> Column:
    out = None
    for name, label in PORTFOLIO.items():
        out = F.when(band == name, label) if out is None else out.when(band == name, label)
    return out


def competition_bucket(n: Column) -> Column:
    return F.when(n.isNull() | (n <= 2), "Low (≤2)").when(n <= 4, "Mid (3-4)").otherwise("High (≥5)")


def price_segment(won: Column, to_next: Column, to_winner: Column) -> Column:
    """to_next: room up to the cheapest rival; to_winner: distance to the winning price."""
    w1, w2, w3, w4, w5, l1, l2, l3, d = SEGMENTS
    winning = F.when(to_next.isNull(), w5).when(to_next < 0, w4).when(to_next <= 0.05, w1).when(to_next <= 0.15, w2).otherwise(w3)
    losing = F.when(to_winner.isNull(), d).when(to_winner >= 0, l3).when(to_winner >= -0.15, l1).otherwise(l2)
    return F.when(won == 1, winning).otherwise(losing)


def segment_order(segment: Column) -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in SEGMENTS]), segment)
