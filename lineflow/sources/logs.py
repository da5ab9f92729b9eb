"""Logging by ``log(level, message)``: Python's logging, or a function of the caller's."""

from __future__ import annotations

import importlib
import logging
from collections.abc import Callable

Log = Callable[[str, str], None]
LEVELS = {"error": logging.ERROR, "warn": logging.WARNING, "info": logging.INFO, "debug": logging.DEBUG}


def log(level: str, message: str) -> None:
    """Write a message to the logger ``lineflow``; what it shows is set there."""
    if level not in LEVELS:
        raise ValueError(f"unknown log level {level!r}, expected one of {', '.join(LEVELS)}")
    logging.getLogger("lineflow").log(LEVELS[level], message)


def imported(place: str) -> Callable:
    """The function named ``module:function``: options of a data source are texts, and executors import what these name."""
    module, colon, name = place.partition(":")
    if not colon:
        raise ValueError(f"expected module:function, not {place!r}")
    found = getattr(importlib.import_module(module), name)
    if not callable(found):
        raise ValueError(f"{place} is not a function")
    return found
