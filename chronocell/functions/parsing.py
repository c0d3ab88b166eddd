"""Driver-side parsing of products, task ids, selectors, ranges, resolutions and configuration."""

from __future__ import annotations

import json
import re
from datetime import date, datetime
from pathlib import Path

from chronocell.functions.periods import Period

TaskId = tuple[str, int, int]


def parse_products(text: str) -> tuple[list[tuple[str, bool]], int]:
    """[(name, indexed)], number of `+` joins. A run of signs is one; its first decides (+ joins, - unions).

    A path may hold hyphens: it ends at a slash that a sign or the end follows.
    """
    parts = re.findall(r"s3://.*?/(?=[+-]|$)|[+-]+|[^+-]+", text.strip("+-") if not text.endswith("/") else text.lstrip("+-"))
    names = [p for p in parts if p[0] not in "+-"]
    return [(n, "s3://" not in n) for n in names], sum(p[0] == "+" for p in parts)


def parse_task(text: str) -> TaskId:
    """period/x/y, with / or , between, x and y with or without their letter; also x+003/y-004/period."""
    parts = [p.strip() for p in re.split(r"[/,]", text)]
    if len(parts) != 3:
        raise ValueError(f"bad task id {text!r}")
    if parts[0].startswith("x"):
        parts = [parts[2], *parts[:2]]
    return parts[0], int(parts[1].lstrip("x")), int(parts[2].lstrip("y"))


def render_task(task: TaskId) -> str:
    return f"{task[0]}/{task[1]:02d}/{task[2]:02d}"


def render_message(task: TaskId, filedb: str) -> str:
    return json.dumps({"filedb": filedb, "tile_idx": render_task(task)})


def parse_message(text: str) -> tuple[TaskId, str]:
    m = json.loads(text)
    return parse_task(m["tile_idx"]), m.get("filedb", "")


def parse_slice(text: str) -> slice:
    parts = text.split(":")
    if len(parts) not in (2, 3):
        raise ValueError(f"bad slice {text!r}")
    return slice(*[int(p) if p.strip() else None for p in parts])


def parse_selector(text: str) -> int | slice | TaskId:
    """A task's number, a slice of numbers, or its id."""
    if re.fullmatch(r"-?\d+", text):
        return int(text)
    return parse_slice(text) if ":" in text else parse_task(text)


def parse_range2d(text: str) -> tuple[tuple[int, int], tuple[int, int]]:
    (a, b), (c, d) = ([int(p) for p in r.split(":")] for r in text.split(","))
    return (a, b), (c, d)


def parse_resolution(text: str) -> tuple[float, float]:
    parts = [float(p) for p in text.split(",")]
    return (-parts[0], parts[0]) if len(parts) == 1 else (parts[0], parts[1])


def compatible_resolution(tile_size: tuple[float, float], resolution: tuple[float, float], tolerance: float = 1e-8) -> bool:
    return all(abs(int(t / abs(r)) * abs(r) - t) < tolerance for t, r in zip(tile_size, resolution, strict=True))


def plain(value):
    """A query as it is stored in a configuration: times as ISO text, periods as theirs, rings of points as GeoJSON."""
    if isinstance(value, dict):
        return {k: plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        ring = len(value) > 3 and value[0] == value[-1] and all(isinstance(p, (list, tuple)) and len(p) == 2 for p in value)
        return {"type": "Polygon", "coordinates": [[list(p) for p in value]]} if ring else [plain(v) for v in value]
    if isinstance(value, Period):
        return value.short
    return value.isoformat() if isinstance(value, (date, datetime)) else value


def load_config(text: str, spark=None) -> dict:
    """YAML (or JSON, its subset) from a file, from an address that Spark reads, or inline; the first document only."""
    if spark is not None and re.fullmatch(r"[a-z0-9]+://\S+", text):
        text = spark.read.text(text, wholetext=True).first()[0] + "\n"
    body = Path(text).read_text() if "\n" not in text and len(text) < 4096 and Path(text).is_file() else text
    try:
        import yaml
    except ImportError:
        return json.loads(body)
    return next(iter(yaml.safe_load_all(body)), None) or {}


def merge_config(config: dict, overrides: dict, allowed: set[str]) -> dict:
    """Options given by hand win over the file; unknown keys are errors."""
    if extra := set(config) - allowed:
        raise ValueError(f"unknown options: {', '.join(sorted(extra))}")
    return {**config, **{k: v for k, v in overrides.items() if v is not None}}
