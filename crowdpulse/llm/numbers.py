"""Whole numbers of any size in columns: limbs that Spark can sum, and texts that sort like the numbers."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMB = 10**17


def limbs(keys: list[tuple[int, ...]], values: list[int], names: list[str]) -> pa.RecordBatch:
    """A row per key and non-zero limb: the key's columns, the limb's place and its part, with the sign."""
    rows = []
    for key, value in zip(keys, values):
        value, sign, place = int(value), 1 if value >= 0 else -1, 0
        rest = abs(value)
        while rest or not place:
            rest, part = divmod(rest, LIMB)
            rows.append((*key, place, sign * part))
            place += 1
    columns = list(zip(*rows)) if rows else [()] * (len(names) + 2)
    kinds = [pa.int32()] * (len(names) + 1) + [pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [*names, "place", "part"])


def shape(names: list[str]) -> str:
    return ", ".join([*(f"{n} int" for n in names), "place int", "part long"])


def summed(parts: DataFrame, names: list[str]) -> dict[tuple[int, ...], int]:
    """The exact total of each key; there must be few of them."""
    total = F.sum(F.col("part").cast("decimal(38,0)")).alias("total")
    out: dict[tuple[int, ...], int] = {}
    for row in parts.groupBy(*names, "place").agg(total).collect():
        key = tuple(row[n] for n in names)
        out[key] = out.get(key, 0) + int(row.total) * LIMB**row.place
    return out


def sortable(value: int) -> str:
    """A text in the order of the numbers: sign, number of digits, digits; complements for negative ones."""
    digits = str(abs(value))
    if value >= 0:
        return f"1{len(digits):04d}{digits}"
    return f"0{9999 - len(digits):04d}" + "".join(str(9 - int(d)) for d in digits)
