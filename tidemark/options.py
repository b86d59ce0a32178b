"""Group options with a data meaning, checked when they are built."""

from __future__ import annotations

import logging
import re
from dataclasses import dataclass

from tidemark.schemas import OFFSET_NEWEST, OFFSET_OLDEST

log = logging.getLogger(__name__)

# Accepted names.
RANGE, ROUND_ROBIN = "range", "roundrobin"
MULTIPLEX, PARTITIONS = "multiplex", "partitions"
INITIAL = {"oldest": OFFSET_OLDEST, "newest": OFFSET_NEWEST}


class OptionError(ValueError):
    """An option has a value outside its rule."""


@dataclass(frozen=True)
class GroupOptions:
    """How a group reads, assigns and commits.

    An unknown strategy is not an error: range is assumed and a log line says so.
    ``commit_retention_ms`` of 0 means the store's default and is recorded as -1.
    """

    group_id: str = "default"
    strategy: str = RANGE
    mode: str = MULTIPLEX
    initial: str = "newest"
    commit_retries: int = 3
    commit_interval_ms: int = 1000
    commit_retention_ms: int = 0
    whitelist: str | None = None
    blacklist: str | None = None
    return_errors: bool = False
    return_notifications: bool = False
    user_data: bytes = b""

    def __post_init__(self) -> None:
        if self.strategy not in (RANGE, ROUND_ROBIN):
            log.warning("strategy %r is not supported; range will be assumed", self.strategy)
            object.__setattr__(self, "strategy", RANGE)
        if self.mode not in (MULTIPLEX, PARTITIONS):
            raise OptionError("mode must be multiplex or partitions")
        if self.initial not in INITIAL:
            raise OptionError("initial must be oldest or newest")
        if self.commit_retries < 0:
            raise OptionError("commit_retries must be >= 0")
        if self.commit_interval_ms <= 0:
            raise OptionError("commit_interval_ms must be > 0")
        for name in ("whitelist", "blacklist"):
            pattern = getattr(self, name)
            if pattern is not None:
                try:
                    re.compile(pattern)
                except re.error as error:
                    raise OptionError(f"{name} is not a pattern: {error}") from error

    @property
    def retention_ms(self) -> int:
        """Retention as stored with a commit."""
        return self.commit_retention_ms or -1

    @property
    def initial_offset(self) -> int:
        """Symbolic start position of partitions without a commit."""
        return INITIAL[self.initial]
