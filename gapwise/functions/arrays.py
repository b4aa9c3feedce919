"""Scans over the aligned arrays of one record.

Every function takes an array of structs ``cntr, resp, service, reason`` as
made by :func:`zip_columns` and returns a column expression. An array lives in
one record, so that nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Number of slots, the service looked for, and the flag rules
# as (flag name, response, reasons). The lower-case "s" is as in the source.
SLOT_COUNT = 10
SERVICE_NAME = "MEDLIMIT"
FLAG_RULES = (
    ("c_e_flag", "s", ("HD", "HC")),
    ("q_r_flag", "H", ("HD",)),
    ("w_aa_flag", "H", ("MX",)),
)

def zip_columns(cntr: str, resp: str, service: str, reason: str, scalar_service: bool = False) -> Column:
    """One array of structs from four aligned arrays; short ones are padded with NULL.

    With ``scalar_service`` the service is one value for the whole record.
    """
    service_array = (
        F.array_repeat(F.col(service), F.size(cntr)) if scalar_service else F.col(service)
    )
    zipped = F.arrays_zip(
        F.col(cntr).alias("cntr"),
        F.col(resp).alias("resp"),
        service_array.alias("service"),
        F.col(reason).alias("reason"),
    )
    return zipped.cast("array<struct<cntr:int,resp:string,service:string,reason:string>>")


def _once(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind a value to a lambda variable, so that the body can use it many times."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _hits(zipped: Column, match: str) -> Column:
    return F.filter(zipped, lambda e: e["service"] == match)


def _joined(hits: Column, field: str, sep: str) -> Column:
    text = F.array_join(hits[field].cast("array<string>"), sep, "")
    return F.when(F.size(hits) == 0, F.lit("")).otherwise(F.concat(text, F.lit(sep)))


def _flag(hits: Column, response: str, reasons: tuple[str, ...]) -> Column:
    found = F.exists(
        hits,
        lambda e: F.coalesce(
            (e["resp"] == response) & e["reason"].isin(*reasons), F.lit(False)
        ),
    )
    return F.when(found, F.lit("Y")).otherwise(F.lit(""))


def match_concat(zipped: Column, field: str, match: str = SERVICE_NAME, sep: str = " ") -> Column:
    """Values of one field at the matching positions, a separator after each one.

    Empty text if nothing matches. A NULL value adds only its separator.
    """
    return _once(_hits(zipped, match), lambda hits: _joined(hits, field, sep))


def match_flag(zipped: Column, response: str, reasons: tuple[str, ...], match: str = SERVICE_NAME) -> Column:
    """``'Y'`` if any matching position has the response and one of the reasons, else ``''``."""
    return _flag(_hits(zipped, match), response, reasons)


def place_in_slots(zipped: Column, slots: int = SLOT_COUNT) -> Column:
    """Array of ``slots`` structs; the element with counter ``n`` lands in slot ``n``.

    The last element wins where a counter repeats. Counters outside
    ``1..slots`` are ignored, empty slots are NULL.
    """

    def placed(elements: Column) -> Column:
        def slot_value(slot: Column) -> Column:
            candidates = F.transform(
                F.filter(elements, lambda e: e["cntr"] == slot),
                lambda e: F.struct(
                    e["resp"].alias("resp"),
                    e["service"].alias("service"),
                    e["reason"].alias("reason_service"),
                ),
            )
            return F.try_element_at(candidates, F.lit(-1))

        return F.transform(F.sequence(F.lit(1), F.lit(slots)), slot_value)

    return _once(F.filter(zipped, lambda e: e["cntr"].between(1, slots)), placed)


def row_flags(resp: Column, reason: Column) -> dict[str, Column]:
    """The same flags at row grain, where no service is asked for."""
    return {
        name: F.when((resp == response) & reason.isin(*reasons), F.lit("Y")).otherwise(F.lit(""))
        for name, response, reasons in FLAG_RULES
    }


def scan_summary(zipped: Column, match: str = SERVICE_NAME, sep: str = " ") -> Column:
    """All results of a scan as one struct of six text fields."""
    return hit_summary(_hits(zipped, match), sep)


def hit_summary(hits: Column, sep: str = " ") -> Column:
    """The same of the matching elements alone, for callers that know a match before they build its struct.

    The elements are bound to a lambda variable, so that they are made once and
    not once per field.
    """

    def summary(hits: Column) -> Column:
        texts = [
            _joined(hits, field, sep).alias(name)
            for name, field in (
                ("service_seq", "cntr"),
                ("resp_flags", "resp"),
                ("reason_codes", "reason"),
            )
        ]
        flags = [_flag(hits, response, reasons).alias(name) for name, response, reasons in FLAG_RULES]
        return F.struct(*texts, *flags)

    return _once(hits, summary)
