"""Log records as JSON lines."""

from __future__ import annotations

import json
import logging
import time


class JsonFormatter(logging.Formatter):
    """One object a record: time in UTC, level, logger, message, and the exception if there is one."""

    def format(self, record: logging.LogRecord) -> str:
        stamp = time.strftime("%Y-%m-%dT%H:%M:%S", time.gmtime(record.created))
        out = {"ts": f"{stamp}.{int(record.msecs):03}Z", "level": record.levelname, "logger": record.name, "message": record.getMessage()}
        if record.exc_info:
            out["exception"] = self.formatException(record.exc_info)
        return json.dumps(out, ensure_ascii=False)
