"""What a Python worker keeps from one task to the next.

Spark gives a worker further tasks once one has ended, also of other operators. A large object that is dear to make is kept for
the next task of its operator; tasks of others release it, or every worker would hold it beside their own tables.
"""

from collections.abc import Callable
from typing import Any

_kept: dict[tuple, Any] = {}


def kept(key: tuple, make: Callable[[], Any]) -> Any:
    """What `make` gives, made once in this worker for `key`; what other keys have left goes."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def release() -> None:
    _kept.clear()
