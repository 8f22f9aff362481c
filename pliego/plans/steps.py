"""Ordered steps with resumable state (driver side)."""

from __future__ import annotations

import json
import os
from collections.abc import Callable


def remaining(steps: list[str], done: set[str], only: str | None = None, start: str | None = None) -> list[str]:
    """What is to run: one step, those from one on, or those not done yet."""
    if only:
        return [s for s in steps if s == only]
    if start:
        return steps[steps.index(start) :]
    return [s for s in steps if s not in done]


def run(steps: dict[str, Callable[[], int | None]], state: str, only: str | None = None, start: str | None = None, restart: bool = False) -> list[str]:
    """Run steps in order; stop at the first that returns other than 0 or None; what is done is kept in the state file."""
    done: set[str] = set()
    if not restart and os.path.exists(state):
        with open(state) as f:
            done = set(json.load(f))
    ran = []
    for name in remaining(list(steps), done, only, start):
        if steps[name]():
            break
        done.add(name)
        ran.append(name)
        with open(state + ".new", "w") as f:
            json.dump(sorted(done), f)
        os.replace(state + ".new", state)
    return ran
