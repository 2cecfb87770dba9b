"""Small fixed tables inside an expression.

A map in Spark is searched entry by entry. Here the entries lie in an array of
buckets by the CRC-32 of their key, so a look-up touches one bucket, whatever
the size of the table. The array is one constant: the optimizer builds it once.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed_table(entries: Mapping[str, object], kind: str = "string") -> Callable[[Column], Column]:
    """A function from a key to its value of type ``kind``, null for keys without one and for null.

    Every entry travels with the plan, so this is for tables of a known size:
    some ten thousand entries at most. Null as a value cannot be told from no entry.
    """
    size = 1 << max(len(entries) - 1, 0).bit_length()
    keys: list[list[str]] = [[] for _ in range(size)]
    values: list[list[object]] = [[] for _ in range(size)]
    for key, value in entries.items():
        bucket = zlib.crc32(key.encode()) % size
        keys[bucket].append(key)
        values[bucket].append(value)
    all_keys = F.from_json(F.lit(json.dumps(keys)), "array<array<string>>")
    all_values = F.from_json(F.lit(json.dumps(values)), f"array<array<{kind}>>")

    def look_up(key: Column) -> Column:
        # without a lambda: one inside another keeps Spark from finding Python functions around them
        bucket = F.pmod(F.crc32(key.cast("binary")), F.lit(size)).cast("int")
        place = F.array_position(F.get(all_keys, bucket), key).cast("int")
        return F.get(F.get(all_values, bucket), place - 1)

    return look_up
