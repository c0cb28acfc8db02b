"""Token sequences: end mark, shift, padding."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

PAD_ID = 0
INTS = "array<int>"


def append_eot(raw_ids: Column, eot_id: int | Column = 2) -> Column:
    return F.concat(raw_ids, F.array(F.lit(eot_id).cast("int")))


def all_but_last(ids: Column) -> Column:
    return F.slice(ids, F.lit(1), F.size(ids) - 1)


def all_but_first(ids: Column) -> Column:
    return F.slice(ids, F.lit(2), F.size(ids) - 1)


def pad_input(ids: Column, width: Column, eot_id: int | Column = 2) -> Column:
    """The ids, one end mark if there is room, then pad ids up to ``width``."""
    room = width - F.size(ids)
    end = F.when(room > 0, F.array(F.lit(eot_id).cast("int"))).otherwise(F.array().cast(INTS))
    return F.concat(ids, end, F.array_repeat(F.lit(PAD_ID), F.greatest(room - 1, F.lit(0))))


def pad_output(ids: Column, width: Column) -> Column:
    """The ids, then pad ids up to ``width``; no end mark."""
    return F.concat(ids, F.array_repeat(F.lit(PAD_ID), F.greatest(width - F.size(ids), F.lit(0))))
