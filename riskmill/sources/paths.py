"""Where the layers live."""

from __future__ import annotations

import re
from dataclasses import dataclass
from pathlib import Path

_SCHEME = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*:")


def resolve(path: str) -> str:
    """A path with a scheme stays as it is; a bare path means the local file system."""
    return path if _SCHEME.match(path) else f"file://{Path(path).absolute()}"


@dataclass(frozen=True)
class Layout:
    """Folders of the layers below one root."""

    root: str = "hdfs:///data"

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze/transactions"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver/transactions_cleaned"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold"

    @property
    def models(self) -> str:
        return f"{self.root}/ml/models"
