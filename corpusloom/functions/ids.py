"""Deterministic identifiers: canonical JSON, version-5 UUIDs and digests, all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the URL name space of RFC 9562.
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"


def canonical_json(fields: dict[str, Column], spaced: bool = False) -> Column:
    """JSON object with sorted keys and nulls kept; compact, or with ", " and ": " between the parts.

    Values are scalars or arrays of scalars.
    """
    keys = sorted(fields)
    if not spaced:
        return F.to_json(F.struct(*[fields[k].alias(k) for k in keys]), {"ignoreNullFields": "false"})
    parts = []
    for k in keys:
        one = F.to_json(F.struct(fields[k].alias("v")), {"ignoreNullFields": "false"})
        parts.append(F.concat(F.lit(f'"{k}": '), F.substring(one, len('{"v":') + 1, 2**30).substr(F.lit(1), F.length(one) - 6)))
    return F.concat(F.lit("{"), F.array_join(F.array(*parts), ", "), F.lit("}"))


def uuid5(name: Column, namespace_hex: str = URL_NAMESPACE) -> Column:
    """Version-5 UUID of a UTF-8 name."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace_hex)), name.cast("binary")))
    variant = F.element_at(F.array(*[F.lit(x) for x in "89ab"]), (F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4) + 1)
    return F.concat_ws(
        "-",
        F.substring(h, 1, 8),
        F.substring(h, 9, 4),
        F.concat(F.lit("5"), F.substring(h, 14, 3)),
        F.concat(variant, F.substring(h, 18, 3)),
        F.substring(h, 21, 12),
    )


def sha256(c: Column) -> Column:
    return F.sha2(c, 256)
