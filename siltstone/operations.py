"""Running the engine: environment files, timing, logging, and what the machine is."""

from __future__ import annotations

import logging
import os
import platform
import time
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

#: Where an environment file is looked for, in order, if none is named.
ENV_PLACES = ("config/.env", ".env")


def load_env(path: str | Path | None = None, places: tuple[str, ...] = ENV_PLACES) -> Path | None:
    """Sets the variables of the first environment file found (``NAME=value`` lines) that are not set yet; returns the file."""
    for p in (Path(x) for x in ([path] if path else []) + list(places)):
        if p.is_file():
            for line in p.read_text(encoding="utf-8").splitlines():
                name, eq, value = line.strip().removeprefix("export ").partition("=")
                if eq and name and not name.startswith("#"):
                    os.environ.setdefault(name.strip(), value.strip().strip("\"'"))
            return p
    return None


def log_to(level: str = "INFO", file: str | None = None) -> logging.Logger:
    """The engine's logger, to the console and, if named, to a file."""
    log = logging.getLogger("siltstone")
    log.setLevel(level)
    log.handlers = [logging.StreamHandler(), *([logging.FileHandler(file, encoding="utf-8")] if file else [])]
    for h in log.handlers:
        h.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(message)s"))
    return log


@contextmanager
def timed(what: str) -> Iterator[dict]:
    """Logs how long a block takes; ``seconds`` is in the yielded dict afterwards."""
    out, began = {}, time.time()
    try:
        yield out
    finally:
        out["seconds"] = time.time() - began
        logging.getLogger("siltstone").info("%s took %.2f s", what, out["seconds"])


def system_info() -> dict:
    """Machine, Python and Spark of the driver."""
    import pyspark

    return {"system": platform.system(), "release": platform.release(), "python": platform.python_version(), "spark": pyspark.__version__, "cpus": os.cpu_count()}
