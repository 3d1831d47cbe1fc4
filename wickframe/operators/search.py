"""Adaptive search over learner settings: a density-ratio sampler and median pruning.

Settings live in unit coordinates (logarithmic ranges on their logarithm). Past trials are ranked; for each
setting one density is built over the best quarter and one over the rest, and of some values drawn from the first the one
with the largest ratio of the two is tried next. All is seeded and depends on finished trials only.
"""

from __future__ import annotations

import math
import random
import statistics
from dataclasses import dataclass, field

GOOD = 0.25  # share of trials that count as good
DRAWS = 24  # values drawn from the density of the good ones


@dataclass
class Trial:
    """One setting: ``scores`` per fold so far (lower is better), whether it was stopped early."""

    number: int
    params: dict
    scores: list[float] = field(default_factory=list)
    pruned: bool = False

    @property
    def score(self) -> float:
        return statistics.fmean(self.scores) if self.scores else math.inf


def to_unit(value: float, low: float, high: float, scale: str) -> float:
    if high <= low:
        return 0.5
    if scale == "log":
        value, low, high = math.log(value), math.log(low), math.log(high)
    return (value - low) / (high - low)


def from_unit(u: float, low: float, high: float, scale: str):
    u = min(max(u, 0.0), 1.0)
    if scale == "int":
        return min(int(low + u * (high - low + 1)), int(high))  # every whole number gets an equal part
    if scale == "log":
        return math.exp(math.log(low) + u * (math.log(high) - math.log(low)))
    return low + u * (high - low)


class Density:
    """Mean of one flat part and a normal bump, cut at 0 and 1, at each point; bumps reach to the farther neighbour."""

    def __init__(self, points: list[float]):
        self.points = sorted(points)
        edges = [0.0, *self.points, 1.0]
        least = 1.0 / min(100, len(points) + 2)
        self.widths = [max(least, edges[i + 1] - edges[i], edges[i + 2] - edges[i + 1]) for i in range(len(points))]

    def draw(self, rng: random.Random) -> float:
        i = rng.randrange(len(self.points) + 1)
        if i == len(self.points):
            return rng.random()
        while not 0 <= (u := rng.gauss(self.points[i], self.widths[i])) <= 1:
            pass  # at least a third of a bump lies inside, since its centre does
        return u

    def at(self, u: float) -> float:
        total = 1.0
        for p, w in zip(self.points, self.widths):
            inside = (math.erf((1 - p) / w / math.sqrt(2)) + math.erf(p / w / math.sqrt(2))) / 2
            total += math.exp(-(((u - p) / w) ** 2) / 2) / (w * math.sqrt(2 * math.pi) * inside)
        return total / (len(self.points) + 1)


def ranked(trials: list[Trial]) -> list[Trial]:
    """Best first: whole trials by score, then stopped ones, those with more folds first; ties to the earlier trial."""
    return sorted(trials, key=lambda t: (t.pruned, -len(t.scores) if t.pruned else 0, t.score, t.number))


def suggest(space: dict, past: list[Trial], rng: random.Random, startup: int = 5) -> dict:
    """Next setting; at random until ``startup`` trials are done."""
    if len(past) < max(startup, 2):
        return {name: from_unit(rng.random(), *bounds) for name, bounds in space.items()}
    order = ranked(past)
    n_good = max(1, math.ceil(GOOD * len(order)))
    out = {}
    for name, bounds in space.items():
        units = [to_unit(t.params[name], *bounds) for t in order]
        good, rest = Density(units[:n_good]), Density(units[n_good:])
        out[name] = from_unit(max((good.draw(rng) for _ in range(DRAWS)), key=lambda u: good.at(u) / rest.at(u)), *bounds)
    return out


def worse_than_median(trial: Trial, past: list[Trial], startup: int = 5, warmup: int = 1) -> bool:
    """Whether the mean so far exceeds the median that whole earlier trials had after as many folds."""
    n = len(trial.scores)
    whole = [t for t in past if not t.pruned and len(t.scores) >= n]
    if len(whole) < max(startup, 1) or n <= warmup:
        return False
    return trial.score > statistics.median(statistics.fmean(t.scores[:n]) for t in whole)
