"""What a Python process keeps from task to task, for one operator at a time.

Spark hands the processes of one stage on to the next. What an operator keeps there would take
memory beside the stages that follow, so their tasks forget it.
"""

from __future__ import annotations

import sys
from collections.abc import Callable


def _kept() -> dict:
    return sys.__dict__.setdefault("_keyedlog_remembered", {})


def remembered(key: tuple, make: Callable[[], object]):
    """What ``make`` returned for this key in this process; what other keys had is forgotten."""
    kept = _kept()
    if key not in kept:
        kept.clear()
        kept[key] = make()
    return kept[key]


def forget() -> None:
    """Called by a task of an operator that keeps nothing itself."""
    _kept().clear()
