"""A paged service whose state lies in files, as tasks and the stream's planner are other processes."""

from __future__ import annotations

import json
import pathlib

from threadloom.sources.paged import Busy


def fetch(resource, cursor, page_size):
    folder = pathlib.Path(resource)
    broken = folder / "broken"
    if broken.exists() and cursor == broken.read_text():
        raise RuntimeError("the service is down")
    busy = folder / "busy"
    if busy.exists():
        busy.unlink()
        raise Busy(0.01)
    rows = json.loads((folder / "rows.json").read_text())
    at = int(cursor or 0)
    page = rows[at : at + page_size]
    return {"results": page, "has_more": at + page_size < len(rows), "next_cursor": str(at + len(page))}
