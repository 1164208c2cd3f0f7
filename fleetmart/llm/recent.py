"""What a worker keeps from task to task, within bounds."""

from __future__ import annotations

from collections.abc import Callable, Hashable
from typing import Any

#: Most keys remembered, twice over (recent and before), and the longest key remembered.
REMEMBERED, LONGEST = 300_000, 48


_kept: dict[Hashable, Any] = {}


def kept(name: Hashable, make: Callable[[], Any]) -> Any:
    """The object of this name, made when first asked for.

    A worker keeps one such object: operators follow each other, and their memories would add up.
    """
    if name not in _kept:
        _kept.clear()
        _kept[name] = make()
    return _kept[name]


class Recent(dict):
    """Values by key; of the older half only those asked for again stay."""

    def __init__(self, make, most: int = REMEMBERED):
        self.make, self.most, self.before = make, most, {}

    def __missing__(self, key):
        value = self.before.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= LONGEST:
            if len(self) >= self.most:
                self.before = self.copy()
                self.clear()
            self[key] = value
        return value
