"""Requests for a batch of backfills: one file, read and checked before anything runs."""

from __future__ import annotations

import datetime as dt
import json
import re
from dataclasses import dataclass, field
from pathlib import Path

SAFE = re.compile(r"[a-z0-9-]+")
MOST_RECORDS = 5000


class RequestError(ValueError):
    """A request that can't be run."""


@dataclass(frozen=True)
class BatchRequest:
    """Journals to be filled for days of one month, as one revision."""

    request_id: str
    start: dt.date
    end: dt.date
    revision: int
    journals: tuple[str, ...]
    provider: str | None = None
    limits: dict[str, int] = field(default_factory=dict)
    overrides: tuple[str, ...] = ()
    planned: tuple[str, ...] = ()

    def check(self) -> BatchRequest:
        """The request itself; a RequestError names all that is wrong with it."""
        named = set(self.journals)
        wrong = {
            "request_id": not re.fullmatch(r"[\w-]+", self.request_id),
            "window": self.start > self.end or (self.start.year, self.start.month) != (self.end.year, self.end.month),
            "revision": self.revision < 1,
            "journals": not self.journals or len(named) < len(self.journals) or not all(map(SAFE.fullmatch, self.journals)),
            "provider": bool(self.provider) and not SAFE.fullmatch(self.provider),
            "limits": not set(self.limits) <= named or any(isinstance(v, bool) or not 1 <= v <= MOST_RECORDS for v in self.limits.values()),
            "overrides": len(set(self.overrides)) < len(self.overrides) or not set(self.overrides) <= named & set(self.limits),
            "planned": len(set(self.planned)) < len(self.planned) or not set(self.planned) <= named,
        }
        if any(wrong.values()):
            raise RequestError(f"backfill request: {[k for k, v in wrong.items() if v]}")
        return self


def batch_request(path: str | Path) -> BatchRequest:
    """A checked request from its JSON file."""
    try:
        raw = json.loads(Path(path).read_text())
        made = BatchRequest(
            str(raw.get("request_id") or ""), dt.date.fromisoformat(raw["acquisition_start"]), dt.date.fromisoformat(raw["acquisition_end"]), int(raw.get("revision") or 0),
            tuple(map(str, raw.get("journals") or ())), (str(raw.get("provider") or "").strip().casefold() or None), dict(raw.get("max_records_by_journal") or {}),
            tuple(map(str, raw.get("policy_override_journals") or ())), tuple(map(str, raw.get("allow_planned_journals") or ())),
        )
    except (KeyError, TypeError, AttributeError, ValueError) as e:
        raise RequestError(f"backfill request can't be read: {e}") from e
    return made.check()
