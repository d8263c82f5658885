"""Named extension points: extractors, chunkers, encoders, indexes, entity and relation extractors."""

from __future__ import annotations

from collections.abc import Callable
from typing import Generic, TypeVar

T = TypeVar("T")


class Registry(Generic[T]):
    """Names (trimmed, lower case) to implementations; an unknown name raises ValueError that lists the known ones."""

    def __init__(self, what: str):
        self.what, self._known = what, {}

    def register(self, *names: str) -> Callable[[T], T]:
        def add(item: T) -> T:
            for name in names:
                self._known[name.strip().lower()] = item
            return item

        return add

    def get(self, name: str) -> T:
        found = self._known.get(name.strip().lower())
        if found is None:
            raise ValueError(f"unknown {self.what} {name!r}; known: {', '.join(sorted(self._known))}")
        return found

    def names(self) -> list[str]:
        return sorted(self._known)
