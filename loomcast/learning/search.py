"""Parameter search over a trial log: density ratios propose, growing shares of rows dismiss.

After a few random trials the log is cut into the better part and the rest. Each parameter
gets a density under either, a mixture of one kernel per trial; candidates are drawn from the
density of the better ones, and the one with the highest ratio of the two densities is tried
next. The log is bounded by the number of trials, so all this is driver work on a few rows.
"""

from __future__ import annotations

import math
import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

Space = Mapping[str, Mapping[str, tuple]]
Point = dict[str, float]


def draw(space: Mapping[str, tuple], rng: random.Random) -> Point:
    """One random point of a search space."""
    return {name: _from_unit(spec, rng.random()) for name, spec in space.items()}


def _from_unit(spec: tuple, u: float) -> float:
    kind, low, high = spec
    if kind == "int":
        return min(high, low + math.floor(u * (high - low + 1)))
    if kind == "log":
        return min(high, max(low, math.exp(math.log(low) + u * (math.log(high) - math.log(low)))))
    return min(high, max(low, low + u * (high - low)))


def _to_unit(spec: tuple, value: float) -> float:
    """Place of a value in its range, from 0 to 1; the middle of its cell for whole numbers."""
    kind, low, high = spec
    if kind == "int":
        return (value - low + 0.5) / (high - low + 1)
    if high == low:
        return 0.5
    if kind == "log":
        return (math.log(value) - math.log(low)) / (math.log(high) - math.log(low))
    return (value - low) / (high - low)


@dataclass(frozen=True)
class Trial:
    """A tried point; ``share`` of the rows was enough to see ``score``, lower is better."""

    family: str
    params: Point
    score: float
    share: float = 1.0
    mae: float | None = None

    @property
    def stopped(self) -> bool:
        return self.share < 1.0


def _normal(x: float, mean: float, width: float) -> float:
    """Density at x of a normal cut to 0..1."""
    inside = 0.5 * (math.erf((1 - mean) / (width * math.sqrt(2))) + math.erf(mean / (width * math.sqrt(2))))
    return math.exp(-0.5 * ((x - mean) / width) ** 2) / (width * math.sqrt(2 * math.pi) * max(inside, 1e-12))


@dataclass(frozen=True)
class Mixture:
    """Kernels around seen places, and one even part that keeps every place possible."""

    places: Sequence[float]

    @property
    def width(self) -> float:
        n = len(self.places)
        if n < 2:
            return 0.3
        mean = sum(self.places) / n
        spread = math.sqrt(sum((p - mean) ** 2 for p in self.places) / n)
        return min(0.5, max(0.1, 0.7 * spread * n**-0.2))

    def density(self, x: float) -> float:
        return (1.0 + sum(_normal(x, p, self.width) for p in self.places)) / (1 + len(self.places))

    def sample(self, rng: random.Random) -> float:
        k = rng.randrange(1 + len(self.places))
        if k == len(self.places):
            return rng.random()
        while True:
            x = rng.gauss(self.places[k], self.width)
            if 0 <= x <= 1:
                return x


@dataclass(frozen=True)
class Searcher:
    """Proposes the next point from the log of one horizon; the same log gives the same point."""

    space: Space
    seed: int = 42
    random_trials: int = 9
    better: float = 0.15
    candidates: int = 8

    def propose(self, log: Sequence[Trial]) -> tuple[str, Point]:
        rng = random.Random(f"{self.seed}:{len(log)}")
        families = list(self.space)
        if len(log) < max(self.random_trials, len(families)):
            family = families[len(log) % len(families)]
            return family, draw(self.space[family], rng)
        # A stopped trial counts as worse than every one that saw all rows.
        ranked = sorted(log, key=lambda t: (t.stopped, t.score))
        cut = max(2, math.ceil(self.better * len(ranked)))
        good, rest = ranked[:cut], ranked[cut:]
        # Families are drawn by their shares among the better trials, each with one trial more.
        family = rng.choices(families, [1 + sum(t.family == f for t in good) for f in families])[0]
        ranges = self.space[family]
        mixtures = {
            name: tuple(Mixture([_to_unit(spec, t.params[name]) for t in part if t.family == family]) for part in (good, rest))
            for name, spec in ranges.items()
        }

        def ratio(point: Point) -> float:
            total = 0.0
            for name, spec in ranges.items():
                x = _to_unit(spec, point[name])
                total += math.log(mixtures[name][0].density(x)) - math.log(mixtures[name][1].density(x))
            return total

        points = [{n: _from_unit(s, mixtures[n][0].sample(rng)) for n, s in ranges.items()} for _ in range(self.candidates)]
        return family, max(points, key=ratio)


def is_poor(score: float, others: Sequence[float], least: int = 3) -> bool:
    """Whether a score is above the median of at least ``least`` others at the same share of rows."""
    if len(others) < least:
        return False
    ordered, n = sorted(others), len(others)
    return score > (ordered[(n - 1) // 2] + ordered[n // 2]) / 2
