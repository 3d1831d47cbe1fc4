"""A bounded memo for values that repeat within a task."""

from __future__ import annotations

from collections.abc import Callable


class Memo(dict):
    """``memo[key]`` computes a value once and keeps it for a while.

    Two generations of at most ``size`` keys: when the young one is full it becomes the old one,
    and a key that is used again moves over. Only speed depends on what is kept.
    """

    __slots__ = ("_make", "_old", "_size")

    def __init__(self, make: Callable, size: int = 250_000):
        super().__init__()
        self._make, self._old, self._size = make, {}, size

    def __missing__(self, key):
        value = self._old.get(key)
        if value is None:
            value = self._make(key)
        if len(self) >= self._size:
            self.age()
        self[key] = value
        return value

    def age(self) -> None:
        """Make the young generation the old one."""
        self._old = dict(self)
        self.clear()

    def recall(self, key) -> bool:
        """Move a key of the old generation over; whether it was there."""
        value = self._old.get(key)
        if value is not None:
            self[key] = value
        return value is not None

    def forget(self) -> None:
        """Drop both generations."""
        self._old = {}
        self.clear()
