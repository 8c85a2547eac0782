"""Plain data that describes an issue log."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field


@dataclass(frozen=True)
class IssueSpec:
    """Ordered first-match tables for one source table.

    ``cases`` holds (condition, column, description); ``levels`` holds
    (condition, severity). The ``other_*`` values apply if nothing matches.
    """

    table: str
    cases: Sequence[tuple[str, str, str]]
    other_column: str
    other_description: str
    levels: Sequence[tuple[str, str]]
    other_level: str
    hidden: Sequence[str] = field(default=())
