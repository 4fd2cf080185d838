"""Expressions over 64-bit cell ids: 4 bits of resolution at bit 52, then 15 digits of 3 bits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RES_AT = 52
RES_MASK = 15 << RES_AT
DIGITS = 15


def resolution(cell: str | Column) -> Column:
    return F.shiftright(F.col(cell) if isinstance(cell, str) else cell, RES_AT).bitwiseAND(F.lit(15)).cast("int")


def cell_to_parent(cell: str | Column, res: int | Column) -> Column:
    """The cell's ancestor at ``res``: its digits below are all ones. NULL where ``res`` is finer than the cell."""
    cell = F.col(cell) if isinstance(cell, str) else cell
    if isinstance(res, int):
        if not 0 <= res <= DIGITS:
            raise ValueError(f"no such resolution: {res}")
        unused = F.lit((1 << 3 * (DIGITS - res)) - 1)
        at = F.lit(res << RES_AT)
        res = F.lit(res)
    else:
        # shift counts must be literals in the Column API
        unused = F.element_at(F.array(*(F.lit((1 << 3 * (DIGITS - r)) - 1) for r in range(DIGITS + 1))), res + 1)
        at = F.element_at(F.array(*(F.lit(r << RES_AT) for r in range(DIGITS + 1))), res + 1)
    parent = cell.bitwiseAND(F.lit(~RES_MASK)).bitwiseOR(at).bitwiseOR(unused)
    return F.when(res <= resolution(cell), parent)


def cell_to_string(cell: str | Column) -> Column:
    return F.lower(F.hex(cell))


def string_to_cell(text: str | Column) -> Column:
    return F.conv(text, 16, 10).cast("bigint")
