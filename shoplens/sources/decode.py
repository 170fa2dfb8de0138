"""CSV line decoders.

``mode="failfast"`` stops the job on a bad line.  ``mode="permissive"`` keeps
good lines; :func:`corrupt_lines` returns the others, so no line is lost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens import schemas

# date pattern of the access log (fixed value)
ACCESS_TIME = "dd/MM/yyyy:HH:mm:ss"


def _part(position: int) -> str:
    # empty fields at the end of a line count as missing
    return f"get(split(trim(TRAILING ',' FROM value), ',', -1), {position})"


def _plain(ddl: str) -> dict[str, str]:
    return {
        name: _part(i) if kind == "STRING" else f"try_cast({_part(i)} AS {kind})"
        for i, (name, kind) in enumerate(schemas.fields(ddl))
    }


_LAYOUTS = {
    "user_behavior": _plain(schemas.USER_BEHAVIOR),
    "access_log": {
        "ip": _part(0),
        "user_id": _part(1),
        "timestamp": f"unix_seconds(try_to_timestamp({_part(3)}, '{ACCESS_TIME}'))",
        "method": _part(5),
        "url": _part(6),
    },
    "marketing": _plain(schemas.MARKETING),
    "ad_click": _plain(schemas.AD_CLICK),
    "login": _plain(schemas.LOGIN),
    "order": _plain(schemas.ORDER),
    "receipt": _plain(schemas.RECEIPT),
}


def _parsed(lines: DataFrame, kind: str) -> DataFrame:
    """``value`` and the fields; a field that is missing or unreadable is null."""
    return lines.select("value", *(F.expr(text).alias(name) for name, text in _LAYOUTS[kind].items()))


def _complete(kind: str):
    return F.expr(" AND ".join(f"{name} IS NOT NULL" for name in _LAYOUTS[kind]))


def decode(lines: DataFrame, kind: str, mode: str = "failfast") -> DataFrame:
    """Records of one kind.  Works on batch and streaming line DataFrames."""
    names = list(_LAYOUTS[kind])
    parsed = _parsed(lines, kind)
    if mode == "permissive":
        return parsed.where(_complete(kind)).select(*names)
    if mode != "failfast":
        raise ValueError(f"unknown mode {mode!r}")
    # the check is a filter, so it also runs for columns the query does not use
    message = F.concat(F.lit(f"bad {kind} line: "), F.coalesce("value", F.lit("null")))
    checked = F.when(_complete(kind), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return parsed.where(checked).select(*names)


def corrupt_lines(lines: DataFrame, kind: str) -> DataFrame:
    """The lines :func:`decode` leaves out in permissive mode, as ``_corrupt``."""
    return _parsed(lines, kind).where(~_complete(kind)).select(F.col("value").alias("_corrupt"))


def decode_user_behavior(lines: DataFrame, mode: str = "failfast") -> DataFrame:
    return decode(lines, "user_behavior", mode)


def decode_access_log(lines: DataFrame, mode: str = "failfast") -> DataFrame:
    return decode(lines, "access_log", mode)


def decode_marketing(lines: DataFrame, mode: str = "failfast") -> DataFrame:
    return decode(lines, "marketing", mode)


def decode_ad_click(lines: DataFrame, mode: str = "failfast") -> DataFrame:
    return decode(lines, "ad_click", mode)


def decode_login(lines: DataFrame, mode: str = "failfast") -> DataFrame:
    return decode(lines, "login", mode)


def decode_order(lines: DataFrame, mode: str = "failfast") -> DataFrame:
    return decode(lines, "order", mode)


def decode_receipt(lines: DataFrame, mode: str = "failfast") -> DataFrame:
    return decode(lines, "receipt", mode)
