"""SetSketch registers and what can be read from them.

Register i holds floor(1 - log_b(smallest of the set's exponential values)). The
registers of a union are the maxima of the registers, so sketches merge; registers
of similar sets agree with about the sets' similarity.
"""

from __future__ import annotations

import numpy as np

from riskloom.llm.common import mix

RATE = 20.0  # of the exponential values
TOP = (1 << 16) - 1
CHUNK = 2048


class SetSketch:
    def __init__(self, registers: int, base: float = 1.02, seed: int = 7):
        self.m, self.base = registers, base
        steps = mix(np.arange(2 * registers, dtype=np.uint64) + np.uint64(seed << 32))
        self.factor, self.shift = steps[:registers] | np.uint64(1), steps[registers:]

    def registers(self, elements: np.ndarray) -> np.ndarray:
        """Registers of a set of 64-bit elements (at least one), as unsigned 16-bit values."""
        highest = np.zeros(self.m, np.uint64)
        x = mix(elements)
        for i in range(0, len(x), CHUNK):
            values = x[i : i + CHUNK, None] * self.factor + self.shift
            np.maximum(highest, values.max(axis=0), out=highest)
        # the largest uniform value gives the smallest exponential one
        gap = ((~highest).astype(np.float64) + 0.5) / 2.0**64
        smallest = -np.log1p(-gap) / RATE
        return np.clip(np.floor(1 - np.log(smallest) / np.log(self.base)), 0, TOP).astype(np.uint16)

    @staticmethod
    def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.maximum(a, b)

    def similarity(self, a: np.ndarray, b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray, steps: int = 101) -> np.ndarray:
        """Maximum-likelihood Jaccard similarity of pairs of sketches with known set sizes.

        The numbers of registers that are larger, smaller and equal are
        multinomial with probabilities that depend on the similarity alone.
        """
        larger, smaller = (a > b).sum(axis=1)[:, None], (a < b).sum(axis=1)[:, None]
        u = (sizes_a / (sizes_a + sizes_b))[:, None]
        v = 1 - u
        j = np.linspace(0, 1, steps)[None, :] * np.minimum(u / v, v / u)

        def exceeds(x: np.ndarray) -> np.ndarray:
            return -np.log1p(-np.clip(x, 0, 1) * (self.base - 1) / self.base) / np.log(self.base)

        up, down = exceeds(u - v * j), exceeds(v - u * j)
        tiny = 1e-12
        score = larger * np.log(up + tiny) + smaller * np.log(down + tiny)
        score += (self.m - larger - smaller) * np.log(np.clip(1 - up - down, tiny, None))
        return np.take_along_axis(j, score.argmax(axis=1)[:, None], axis=1)[:, 0]
