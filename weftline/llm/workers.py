"""What the Python operators need inside a task."""

from __future__ import annotations

import hashlib
from collections.abc import Callable


class Memo(dict):
    """A dictionary that computes missing values and starts afresh beyond ``limit`` entries, so its memory is bounded."""

    def __init__(self, compute: Callable, limit: int):
        super().__init__()
        self.compute, self.limit = compute, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.compute(key)
        return value


class Generations(dict):
    """A dictionary of bounded memory that forgets what was not used for longest: two generations of up to ``limit`` entries.

    A full young generation becomes the old one; what is asked for again is taken back from there. Values must not be None.
    """

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.old = limit, {}

    def missing(self, keys: set) -> list:
        """Those of ``keys`` that no generation has. Afterwards all others are in the young one."""
        unknown = []
        for key in keys.difference(self):
            value = self.old.get(key)
            if value is None:
                unknown.append(key)
            else:
                self[key] = value
        return unknown

    def age(self) -> None:
        """To be called between two uses: what is young now stays at hand for one more generation."""
        if len(self) > self.limit:
            self.old = dict(self)
            self.clear()


_built: dict[str, tuple] = {}


def once_per_worker(kind: str, key, build: Callable):
    """The object of a kind for ``key``. A Python worker lives on between tasks and keeps the last one of each kind."""
    if kind not in _built or _built[kind][0] != key:
        _built[kind] = key, build()
    return _built[kind][1]


def fingerprint(*contents) -> str:
    """A key that follows what is in the given texts, bytes or collections."""
    return hashlib.sha256(repr(contents).encode()).hexdigest()
