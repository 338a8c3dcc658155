"""Column names as users write them."""

from __future__ import annotations


def trim_backticks(name: str | None) -> str | None:
    """The bare column name: one pair of enclosing backticks is taken off.

    An opening backtick without its closing one is an error.
    """
    if not name or not name.startswith("`"):
        return name
    if len(name) < 2 or not name.endswith("`"):
        raise ValueError(f"column name {name!r} opens a backtick that it does not close")
    return name[1:-1]
