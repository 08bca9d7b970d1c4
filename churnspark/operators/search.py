"""Parameter draws that learn from the losses of earlier ones.

Trials are split into a good and a bad part by loss. Each part gives a density per parameter: a mixture
of normals around its values, cut off at the bounds, and a flat one over the whole range. New
values are drawn from the good density, and of several the one is taken whose good density is highest
against its bad one. Trials come in rounds, so that their models can be fitted side by side;
draws of a round that have no loss yet count as bad, which keeps a round from crowding together.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from statistics import NormalDist

Draw = dict[str, float | int]
Space = Mapping[str, tuple]

# Share of the trials that count as good, and how many values are weighed against each other per draw.
GOOD_SHARE, CANDIDATES = 0.25, 24


def cast_draw(drawn: Mapping[str, float]) -> Draw:
    """A value without a fraction becomes an int."""
    return {name: int(v) if float(v).is_integer() else v for name, v in drawn.items()}


def _stepped(value: float, low: float, high: float, step: float) -> float:
    """The nearest multiple of the step within the bounds."""
    first, last = math.ceil(low / step), math.floor(high / step)
    return min(max(round(value / step), first), last) * step


def random_draw(space: Space, generator: random.Random) -> Draw:
    drawn = {}
    for name, (kind, low, high, *step) in space.items():
        value = generator.uniform(low, high)
        drawn[name] = _stepped(value, low, high, step[0]) if kind == "quniform" else value
    return cast_draw(drawn)


class _Density:
    """Mixture of normals around some values between two bounds, and a flat part of one value's weight."""

    def __init__(self, values: Sequence[float], low: float, high: float) -> None:
        self.low, self.high = low, high
        span = high - low
        points = sorted(values)
        least = span / min(100, len(points) + 2)
        self.parts = []
        for i, point in enumerate(points):
            left = point - (points[i - 1] if i else low)
            right = (points[i + 1] if i + 1 < len(points) else high) - point
            normal = NormalDist(point, min(max(left, right, least), span) or 1.0)
            below, above = normal.cdf(low), normal.cdf(high)
            self.parts.append((normal, below, max(above - below, 1e-12)))

    def draw(self, generator: random.Random) -> float:
        chosen = generator.randrange(len(self.parts) + 1)
        if chosen == len(self.parts):
            return generator.uniform(self.low, self.high)
        normal, below, mass = self.parts[chosen]
        share = min(max(below + mass * generator.random(), 1e-12), 1 - 1e-12)
        return min(max(normal.inv_cdf(share), self.low), self.high)

    def log(self, value: float) -> float:
        span = self.high - self.low
        flat = 1 / span if span else 1.0
        total = flat + sum(normal.pdf(value) / mass for normal, _, mass in self.parts)
        return math.log(total / (len(self.parts) + 1))


@dataclass
class AdaptiveSearch:
    """Suggests draws from a space; ``tell`` reports their losses (lower is better)."""

    space: Space
    seed: int = 42
    startup: int = 6
    good_share: float = GOOD_SHARE
    candidates: int = CANDIDATES
    trials: list[tuple[Draw, float]] = field(default_factory=list)

    def __post_init__(self) -> None:
        self._generator = random.Random(self.seed)

    def _known(self, drawn: Draw, pending: Sequence[Draw]) -> bool:
        return any(drawn == d for d, _ in self.trials) or drawn in pending

    def ask(self, pending: Sequence[Draw] = ()) -> Draw:
        """The next draw, not one of the earlier ones as long as others are found."""
        if len(self.trials) < self.startup:
            tried = [random_draw(self.space, self._generator) for _ in range(self.candidates)]
            return next((d for d in tried if not self._known(d, pending)), tried[0])
        ranked = [d for d, _ in sorted(self.trials, key=lambda t: t[1])]
        many = max(1, math.ceil(self.good_share * len(ranked)))
        good, bad = ranked[:many], [*ranked[many:], *pending]
        options = []
        for _ in range(self.candidates):
            drawn, score = {}, 0.0
            for name, (kind, low, high, *step) in self.space.items():
                likely = _Density([d[name] for d in good], low, high)
                unlikely = _Density([d[name] for d in bad], low, high)
                value = likely.draw(self._generator)
                drawn[name] = _stepped(value, low, high, step[0]) if kind == "quniform" else value
                score += likely.log(drawn[name]) - unlikely.log(drawn[name])
            options.append((score, cast_draw(drawn)))
        options.sort(key=lambda o: -o[0])
        return next((d for _, d in options if not self._known(d, pending)), options[0][1])

    def tell(self, drawn: Draw, loss: float) -> None:
        self.trials.append((drawn, loss))

    def best(self) -> tuple[Draw, float]:
        return min(self.trials, key=lambda t: t[1])


def minimise(
    space: Space, evaluate: Callable[[list[Draw]], list[float]], trials: int, seed: int = 42, round_size: int = 4
) -> AdaptiveSearch:
    """``trials`` draws in rounds of ``round_size``; ``evaluate`` gives the losses of a round.

    A space with fewer values than trials is seen whole; draws that repeat are not evaluated again.
    """
    search = AdaptiveSearch(space, seed, startup=min(max(round_size, 6), max(trials // 2, 1)))
    while len(search.trials) < trials:
        draws: list[Draw] = []
        for _ in range(min(round_size, trials - len(search.trials))):
            draws.append(search.ask(draws))
        known = {tuple(sorted(d.items())): loss for d, loss in search.trials}
        new = [d for i, d in enumerate(draws) if tuple(sorted(d.items())) not in known and d not in draws[:i]]
        if new:
            known.update({tuple(sorted(d.items())): loss for d, loss in zip(new, evaluate(new), strict=True)})
        for drawn in draws:
            search.tell(drawn, known[tuple(sorted(drawn.items()))])
    return search
