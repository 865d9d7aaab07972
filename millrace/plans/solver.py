"""Limited-memory quasi-Newton steps on sums that Spark makes: many models move in one scan, none needs a square matrix."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np

#: Values of all parameter vectors that move together: bounds what one task adds up and the driver receives.
VECTOR_CELLS = 4_000_000
#: Values of the mapped rows that a task holds at once.
ROW_CELLS = 2_000_000


def row_parts(n: int, width: int) -> Iterator[slice]:
    """Slices of n rows that hold at most ROW_CELLS values each once they are `width` wide."""
    step = max(1, ROW_CELLS // max(1, width))
    return (slice(i, i + step) for i in range(0, n, step))


@dataclass
class Descent:
    """One model on its way down: a point, the last curvature pairs, and a line search between `low` and `high`."""

    x: np.ndarray
    scale: np.ndarray
    memory: int
    loss: float | None = None
    gradient: np.ndarray | None = None
    first: float = 0.0
    pairs: list = field(default_factory=list)
    direction: np.ndarray | None = None
    step: float = 1.0
    low: float = 0.0
    high: float = np.inf
    done: bool = False

    def trial(self) -> np.ndarray:
        return self.x if self.loss is None else self.x + self.step * self.direction

    def _aim(self) -> None:
        q = self.gradient.copy()
        kept = []
        for s, y, rho in reversed(self.pairs):
            a = rho * (s @ q)
            q -= a * y
            kept.append(a)
        s, y, rho = self.pairs[-1] if self.pairs else (None, None, None)
        q *= self.scale if s is None else self.scale / (rho * (y @ (self.scale * y)))
        for (s, y, rho), a in zip(self.pairs, reversed(kept)):
            q += (a - rho * (y @ q)) * s
        self.direction, self.step, self.low, self.high = -q, 1.0, 0.0, np.inf

    def _settle(self, tolerance: float) -> None:
        size = float(np.sqrt(self.gradient @ self.gradient))
        self.done = size <= tolerance * self.first
        if not self.done:
            self._aim()

    def take(self, loss: float, gradient: np.ndarray, tolerance: float) -> None:
        """Loss and gradient at trial(): a step that descends enough and flattens enough is taken, another is bracketed."""
        if self.loss is None:
            self.loss, self.gradient = loss, gradient
            self.first = float(np.sqrt(gradient @ gradient))
            self._settle(tolerance)
            return
        slope = float(self.gradient @ self.direction)
        rounding = 1e-14 * abs(self.loss)
        if not loss <= self.loss + 1e-4 * self.step * slope + rounding:
            self.high = self.step
        elif float(gradient @ self.direction) < 0.9 * slope:
            self.low = self.step
        else:
            s, y = self.step * self.direction, gradient - self.gradient
            if s @ y > 1e-14 * np.sqrt((s @ s) * (y @ y)):
                self.pairs = [*self.pairs, (s, y, 1.0 / (s @ y))][-self.memory :]
            self.x, self.loss, self.gradient = self.x + s, loss, gradient
            self._settle(tolerance)
            return
        self.step = 2.0 * self.low if self.high == np.inf else (self.low + self.high) / 2.0
        # Between two steps that rounding cannot tell apart there is nothing left to gain.
        self.done = self.high - self.low < 1e-10 * self.high if self.high < np.inf else False


def minimise(
    evaluate: Callable[[dict[int, np.ndarray]], dict[int, tuple[float, np.ndarray]]],
    starts: list[np.ndarray],
    scales: list[np.ndarray] | None = None,
    tolerance: float = 1e-5,
    memory: int = 20,
    scans: int = 2_000,
) -> list[Descent]:
    """Minimise several smooth functions side by side; evaluate() gives loss and gradient of those still moving, in one scan.

    A model is done once its gradient is `tolerance` times the one it started with. `scales` are inverse curvatures by
    coordinate for the first step. Models not done after `scans` scans are an error: there is no silent stop.
    """
    models = [Descent(x.astype(float), np.ones(len(x)) if scales is None else scales[i], memory) for i, x in enumerate(starts)]
    for _ in range(scans):
        moving = {i: m.trial() for i, m in enumerate(models) if not m.done}
        if not moving:
            return models
        for i, (loss, gradient) in evaluate(moving).items():
            models[i].take(loss, gradient, tolerance)
    if all(m.done for m in models):
        return models
    raise ArithmeticError(f"{sum(not m.done for m in models)} of {len(models)} models not done after {scans} scans")
