"""Column names that a table does not have yet."""

from __future__ import annotations

from collections.abc import Sequence


def unused(columns: Sequence[str], *names: str) -> list[str]:
    """Each name, with underscores added until no column is called so, whatever its case."""
    taken = {c.lower() for c in columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found
