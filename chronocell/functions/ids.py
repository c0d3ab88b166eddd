"""Deterministic ids: UUID v5 of lower-cased lines."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Name space of deterministic ids.
NAMESPACE = uuid.UUID("6f34c6f4-13d6-43c0-8e4e-42b6c13203af")


def deterministic_id(algorithm: str, version: str, sources: Sequence[str], deployment: str = "", **tags) -> uuid.UUID:
    """UUID v5 over lower-cased lines: algorithm, version, deployment, sorted tags, sorted sources."""
    lines = [algorithm, version, deployment, *sorted(f"{k}={v}" for k, v in tags.items()), *map(str, sorted(sources))]
    return uuid.uuid5(NAMESPACE, "\n".join(str(x) for x in lines).lower())


def uuid5_column(name: Column, namespace: uuid.UUID = NAMESPACE) -> Column:
    """The same as a column: SHA-1 of the name space and text, with version and variant bits set."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), F.encode(name, "UTF-8")))
    variant = F.element_at(F.array(*[F.lit(c) for c in "89ab"]), (F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4) + 1)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))
