"""Choosing the next parameter sets from those that have been tried, by Parzen estimators.

Finished trials are split into the best fifth and the rest.  Per parameter both groups get a density: a Gaussian around each value, as wide
as the distance to its neighbours, and a flat one over the whole range.  Candidates are drawn from the density of the good ones;
the one whose good density is largest against the other is next.  Only the table of trials is held, one row per trial.
"""

from __future__ import annotations

import math
import random

STARTUP, CANDIDATES, GOOD = 10, 24, 0.2
# Parameters that are drawn on a logarithmic scale.
LOGARITHMIC = {"learning_rate"}


def draw(name: str, low: float, high: float, rng: random.Random):
    """One value between the bounds; whole where both bounds are."""
    if isinstance(low, int) and isinstance(high, int):
        return rng.randint(low, high)
    if name in LOGARITHMIC:
        return math.exp(rng.uniform(math.log(low), math.log(high)))
    return rng.uniform(low, high)


class _Density:
    """Mixture of Gaussians around values in [0, 1], and of the flat density, in equal parts."""

    def __init__(self, values: list[float]):
        self.values = sorted(values)
        edges = [0.0, *self.values, 1.0]
        least = 1.0 / min(100, 1 + len(edges))
        self.widths = [max(b - a, c - b, least) for a, b, c in zip(edges, edges[1:], edges[2:])]

    def draw(self, rng: random.Random) -> float:
        i = rng.randrange(len(self.values) + 1)
        if i == len(self.values):
            return rng.random()
        while True:
            x = rng.gauss(self.values[i], self.widths[i])
            if 0 <= x <= 1:
                return x

    def log(self, x: float) -> float:
        total = 1.0
        for v, w in zip(self.values, self.widths):
            inside = 0.5 * (math.erf((1 - v) / (w * math.sqrt(2))) + math.erf(v / (w * math.sqrt(2))))
            total += math.exp(-0.5 * ((x - v) / w) ** 2) / (w * math.sqrt(2 * math.pi) * inside)
        return math.log(total / (len(self.values) + 1))


def _to_unit(name: str, low: float, high: float, value: float) -> float:
    if name in LOGARITHMIC:
        low, high, value = math.log(low), math.log(high), math.log(value)
    return (value - low) / (high - low) if high > low else 0.5


def _from_unit(name: str, low: float, high: float, x: float):
    if isinstance(low, int) and isinstance(high, int):
        return min(high, low + math.floor(x * (high - low + 1)))
    if name in LOGARITHMIC:
        return math.exp(math.log(low) + x * (math.log(high) - math.log(low)))
    return low + x * (high - low)


def suggest(finished: list[tuple[dict, float | None]], bounds: dict, n: int, seed: int = 42) -> list[dict]:
    """The next ``n`` parameter sets, given (parameters, metric to be maximised) of the finished ones, in order.

    The first ``STARTUP`` sets are drawn evenly.  The outcome depends on the arguments only.
    """
    out = []
    for i in range(n):
        rng = random.Random(f"{seed}/{len(finished) + i}")
        if len(finished) < STARTUP:
            out.append({k: draw(k, *b, rng) for k, b in bounds.items()})
            continue
        ranked = [t for t, _ in sorted(finished, key=lambda f: -(f[1] if f[1] is not None else -math.inf))]
        cut = math.ceil(GOOD * len(ranked))
        chosen = {}
        for k, (low, high) in bounds.items():
            good, rest = (_Density([_to_unit(k, low, high, t[k]) for t in part]) for part in (ranked[:cut], ranked[cut:]))
            xs = [good.draw(rng) for _ in range(CANDIDATES)]
            chosen[k] = _from_unit(k, low, high, max(xs, key=lambda x: good.log(x) - rest.log(x)))
        out.append(chosen)
    return out
