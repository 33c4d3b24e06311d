"""Word codes of texts in bounded slices, for the classifiers."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1_500_000
WORD = re.compile(r"\w+")


def slices(texts: list[str | None], most: int = SLICE) -> Iterator[tuple[int, list[str]]]:
    """(first index, texts) of runs of at most ``most`` characters, or of one longer text; null becomes empty."""
    start, size, run = 0, 0, []
    for i, t in enumerate(texts):
        t = t or ""
        if run and size + len(t) > most:
            yield start, run
            start, size, run = i, 0, []
        size += len(t)
        run.append(t)
    if run:
        yield start, run


def memo(most: int):
    """Remembers up to ``most`` results; unlike functools' cache the wrapped function can be pickled by value."""

    def wrap(fn):
        known: dict = {}

        def call(*args):
            if args not in known:
                if len(known) >= most:
                    known.clear()
                known[args] = fn(*args)
            return known[args]

        call.clear = known.clear
        return call

    return wrap


def encode(lists: list[list[str]]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Codes of all words, where each text's words start (one more than texts), and the distinct words."""
    starts = np.zeros(len(lists) + 1, dtype=np.int64)
    np.cumsum([len(x) for x in lists], out=starts[1:])
    flat = [w for x in lists for w in x]
    coded = pa.array(flat, pa.string()).dictionary_encode() if flat else None
    if coded is None:
        return np.zeros(0, dtype=np.int64), starts, []
    return coded.indices.to_numpy().astype(np.int64), starts, coded.dictionary.to_pylist()


def hashed(kind: str, value: str, size: int) -> int:
    return zlib.crc32(f"{kind}{value}".encode("utf-8", "replace")) % size


def logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-2, rounds: int = 30) -> np.ndarray:
    """Weights (the last is the intercept) by Newton's method; a single class gives the intercept of its smoothed share."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    share = (y.sum() + 0.5) / (len(y) + 1.0)
    w[-1] = np.log(share / (1 - share))
    if not 0 < y.sum() < len(y):
        return w
    ridge = np.eye(len(w)) * l2 * len(y) / 100
    for _ in range(rounds):
        p = logistic(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge + 1e-6 * np.eye(len(w)), x.T @ (p - y) + ridge @ w)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w
