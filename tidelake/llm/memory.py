"""What a Python worker remembers from task to task.

Workers serve the tasks of several operators in turn. What one operator remembers is
dropped when a task of another one begins in the same worker.
"""

from __future__ import annotations

from collections.abc import Callable

_held: dict[str, Callable[[], None]] = {}


def enter(operator: str, release: Callable[[], None] | None = None) -> None:
    """A task of ``operator`` begins; ``release`` will drop what it remembers."""
    for name in [name for name in _held if name != operator]:
        _held.pop(name)()
    if release is not None:
        _held[operator] = release
