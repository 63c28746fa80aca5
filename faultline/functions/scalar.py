"""Scalar column expressions (PRJ-1, 7..10, 15, DOR-1)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from faultline.schemas import FEATURE_KEY_FORMAT, MACHINE_CLASSES


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ms_to_timestamp(ms) -> Column:
    """PRJ-1: epoch milliseconds -> timestamp (UTC session)."""
    return F.timestamp_millis(_col(ms))


def machine_class(machine_id) -> Column:
    """PRJ-15: class from the machine id, cycling A, B, C from id 1."""
    idx = F.pmod(_col(machine_id) - 1, F.lit(len(MACHINE_CLASSES)))
    expr = F.when(idx == 0, F.lit(MACHINE_CLASSES[0]))
    for i, cls in enumerate(MACHINE_CLASSES[1:], start=1):
        expr = expr.when(idx == i, F.lit(cls))
    return expr


def fahrenheit(celsius) -> Column:
    """DOR-1: Celsius -> Fahrenheit."""
    return _col(celsius) * 9 / 5 + 32


def parse_number(text) -> Column:
    """PRJ-10: stored string -> double; null, ``"None"`` or junk -> null.  The
    shape is checked first: Java's parser also takes ``"1d"`` or ``"0x1p3"``."""
    shape = r"^\s*[+-]?((\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?|(?i:nan|inf(inity)?))\s*$"
    return F.when(_col(text).rlike(shape), _col(text).try_cast("double"))


def feature_key(machine_id, name) -> Column:
    """PRJ-9: ``feature:machine_id={id}:{name}``."""
    return F.format_string(FEATURE_KEY_FORMAT, _col(machine_id).cast("string"), _col(name))
