"""Stage runner: ordered stages, each with a verdict; a failure does not stop the later ones."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field


@dataclass
class Stage:
    name: str
    run: Callable[[], int]
    pending: Callable[[], int] | None = None
    available: Callable[[], bool] = lambda: True


@dataclass
class Outcome:
    rows: list[dict] = field(default_factory=list)

    @property
    def ok(self) -> bool:
        return bool(self.rows) and all(r["verdict"] in ("done", "skipped") for r in self.rows)

    @property
    def exit_code(self) -> int:
        return 0 if self.ok else 1


def decide(pending: int, available: bool) -> str:
    """skip without work, blocked when work cannot be done, else run."""
    return "skip" if pending == 0 else "run" if available else "blocked"


def run_stages(stages: list[Stage]) -> Outcome:
    """Every stage's verdict and count; no stages at all is a failure."""
    out = Outcome()
    for s in stages:
        what = decide(s.pending() if s.pending else 1, s.available())
        if what == "run":
            try:
                out.rows.append({"stage": s.name, "verdict": "done", "count": s.run(), "error": None})
            except Exception as e:  # a stage's failure is its verdict
                out.rows.append({"stage": s.name, "verdict": "failed", "count": 0, "error": f"{type(e).__name__}: {e}"})
        else:
            out.rows.append({"stage": s.name, "verdict": {"skip": "skipped"}.get(what, what), "count": 0, "error": None})
    return out
