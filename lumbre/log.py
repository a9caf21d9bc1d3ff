"""Log lines of a level, a message and key=value fields."""

from __future__ import annotations

import json
import logging
from datetime import datetime, timezone


def shown(value: object) -> str:
    """A value as it stands after its key: text with white space, and structures, as JSON."""
    if value is None or isinstance(value, bool):
        return {None: "null", True: "true", False: "false"}[value]
    if isinstance(value, str):
        return json.dumps(value, ensure_ascii=False) if any(c.isspace() for c in value) else value
    return str(value) if isinstance(value, (int, float)) else json.dumps(value, ensure_ascii=False, default=str)


class KeyValues(logging.Formatter):
    """Time, level, message, and the fields given as ``extra={"fields": {..}}``."""

    def format(self, record: logging.LogRecord) -> str:
        stamp = datetime.fromtimestamp(record.created, timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%f")[:-3] + "Z"
        fields = "".join(f" {k}={shown(v)}" for k, v in getattr(record, "fields", {}).items())
        return f"{stamp} {record.levelname:<5} {record.getMessage()}{fields}"


def set_up(verbose: bool) -> None:
    handler = logging.StreamHandler()
    handler.setFormatter(KeyValues())
    logging.basicConfig(level=logging.DEBUG if verbose else logging.INFO, handlers=[handler], force=True)
