"""Small hand-made inputs."""

from __future__ import annotations

import gzip
import json
from datetime import datetime, timezone
from pathlib import Path

from tallyhouse.schemas import RAW_SCHEMA


def at(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def record(id, when="2024-05-01T10:00:00", type="PushEvent", actor="ann", repo="o/r", **extra):
    """A landed record as a dict; None leaves a part out."""
    doc = {"id": id, "type": type, "created_at": when and f"{when}Z", "public": True, **extra}
    if actor is not None:
        doc["actor"] = {"id": 7, "login": actor}
    if repo is not None:
        doc["repo"] = {"id": 9, "name": repo}
    return doc


def raw_row(id, when="2024-05-01T10:00:00", type="PushEvent", actor="ann", repo="o/r",
            payload=None, public=True, org=None):
    """A raw table row."""
    return (
        id,
        type,
        None if actor is None else json.dumps({"id": 7, "login": actor}),
        None if repo is None else json.dumps({"id": 9, "name": repo}),
        payload,
        public,
        None if when is None else at(when),
        org,
    )


def raw_frame(spark, *rows):
    return spark.createDataFrame(list(rows), RAW_SCHEMA)


def land(root: Path, day: str, hour: int, docs, suffix="ndjson", extra_lines=()):
    """Write one landed hour in the default layout."""
    folder = Path(root) / day / "hours"
    folder.mkdir(parents=True, exist_ok=True)
    text = "".join(line + "\n" for line in [*map(json.dumps, docs), *extra_lines])
    path = folder / f"{hour:02d}.{suffix}"
    path.write_bytes(gzip.compress(text.encode()) if suffix.endswith("gz") else text.encode())


def plan(df) -> str:
    return df._jdf.queryExecution().toString()
