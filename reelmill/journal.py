"""Log lines with the item, the channel and the action they are about."""

from __future__ import annotations

import logging
from collections.abc import MutableMapping
from typing import Any

FORMAT = "%(asctime)s %(levelname)s video=%(video_id)s channel=%(channel_id)s action=%(action)s %(message)s"


class Journal(logging.LoggerAdapter):
    def process(self, msg: Any, kwargs: MutableMapping[str, Any]) -> tuple[Any, MutableMapping[str, Any]]:
        kwargs["extra"] = dict(self.extra or {}) | dict(kwargs.get("extra") or {})
        return msg, kwargs


def journal(video_id: str = "-", channel_id: str = "-", action: str = "-") -> Journal:
    return Journal(logging.getLogger("reelmill"), {"video_id": video_id, "channel_id": channel_id, "action": action})


def configure(level: int = logging.INFO) -> None:
    """Lines of this package on standard error, in one format; a second call changes nothing but the level."""
    logger = logging.getLogger("reelmill")
    logger.setLevel(level)
    if not logger.handlers:
        handler = logging.StreamHandler()
        handler.setFormatter(logging.Formatter(FORMAT, defaults={"video_id": "-", "channel_id": "-", "action": "-"}))
        logger.addHandler(handler)
