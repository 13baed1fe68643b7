"""Where an engine's tables lie: a root folder, and four places that environment variables may move."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass
from pathlib import PurePosixPath

STORE, QUEUE, REVIEWS, NOTES = "THREADLOOM_STORE", "THREADLOOM_QUEUE", "THREADLOOM_REVIEWS", "THREADLOOM_NOTES"


class ConfinementError(ValueError):
    """A path leaves the folder that it must stay in."""


@dataclass(frozen=True)
class Config:
    """``notes`` is null where no folder of notes is set."""

    store: str
    queue: str
    reviews: str
    notes: str | None

    @classmethod
    def load(cls, root: str, env: Mapping[str, str] | None = None) -> Config:
        source, root = os.environ if env is None else env, root.rstrip("/")
        return cls(source.get(STORE, f"{root}/store"), source.get(QUEUE, f"{root}/queue"), source.get(REVIEWS, f"{root}/reviews"), source.get(NOTES))

    def shown(self) -> dict[str, str | None]:
        """The settings by the variables' names."""
        return {STORE: self.store, QUEUE: self.queue, REVIEWS: self.reviews, NOTES: self.notes}


def confined(path: str, root: str) -> str:
    """``path`` (relative paths: below ``root``) without . and .. steps; ConfinementError if it isn't below ``root``. Schemes must agree; links are the file system's matter."""

    def parts(x: str) -> tuple[str, list[str]]:
        scheme, sep, rest = x.partition("://")
        scheme, rest = (scheme, rest) if sep else ("", x)
        out: list[str] = []
        for step in PurePosixPath(rest).parts:
            if step == "..":
                if not out or out == ["/"]:
                    raise ConfinementError(f"{path} leaves {root}")
                out.pop()
            elif step != ".":
                out.append(step)
        return scheme, out

    whole = path if path.startswith("/") or "://" in path else f"{root.rstrip('/')}/{path}"
    (scheme, own), (root_scheme, above) = parts(whole), parts(root)
    if scheme != root_scheme or own[: len(above)] != above or len(own) == len(above):
        raise ConfinementError(f"{path} leaves {root}")
    joined = "/".join(own).replace("//", "/", 1) if own[:1] == ["/"] else "/".join(own)
    return f"{scheme}://{joined}" if scheme else joined
