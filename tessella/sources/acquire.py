"""Acquisition from web services: requests, retries, quartering. How to fetch is the caller's; nothing here opens a socket."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Sequence

from ..operators.quality import MIRRORS
from ..operators.spatial import quadrants

# Fixed values of the requests.
WATER_CLAUSES = (("way", "natural", "water"), ("relation", "natural", "water"), ("way", "waterway", "riverbank"), ("relation", "waterway", "riverbank"), ("way", "natural", "coastline"), ("way", "natural", "wetland"), ("relation", "natural", "wetland"))
QUERY_SECONDS = 180
TRIES, FIRST_WAIT = 4, 5.0
MOST_SPLITS = 3
OCEAN = 0.95


def water_query(box: tuple[float, float, float, float], clauses: Sequence[tuple[str, str, str]] = WATER_CLAUSES) -> str:
    """The query for all elements with the tags in a box (south, west, north, east), with their geometry."""
    inside = ",".join(f"{x}" for x in box)
    body = "".join(f'{kind}["{key}"="{value}"]({inside});' for kind, key, value in clauses)
    return f"[out:json][timeout:{QUERY_SECONDS}];({body});out geom;"


def coverage_request(endpoint: str, coverage: str, box: tuple[float, float, float, float], cell: float, **more: str) -> str:
    """A coverage service's request for a box as a GeoTIFF of square cells."""
    s, w, n, e = box
    cols, rows = max(1, round((e - w) / cell)), max(1, round((n - s) / cell))
    fields = {"service": "WCS", "version": "1.0.0", "request": "GetCoverage", "coverage": coverage, **more, "format": "GeoTIFF", "crs": "EPSG:4326", "response_crs": "EPSG:4326", "bbox": f"{w},{s},{e},{n}", "width": cols, "height": rows}
    return endpoint + "?" + "&".join(f"{k}={v}" for k, v in fields.items())


def checked_tiff(body: bytes) -> bytes:
    """body, or an error if it does not begin like a TIFF file: services answer errors as text."""
    if body[:2] not in (b"II", b"MM"):
        raise ValueError(f"not a TIFF file: {body[:100]!r}")
    return body


def with_retries(get: Callable[[], bytes], tries: int = TRIES, first_wait: float = FIRST_WAIT, sleep: Callable[[float], None] = time.sleep) -> bytes:
    """get(), tried again after waits that double; the last error if none succeeds."""
    for k in range(tries):
        try:
            return get()
        except Exception as e:
            if k + 1 == tries:
                raise RuntimeError(f"no answer in {tries} tries") from e
            sleep(first_wait * 2**k)
    raise ValueError("no tries")


def elements(box: tuple[float, float, float, float], ask: Sequence[Callable[[str], bytes]], ocean: float = 0.0, depth: int = 0, mirrors: int = MIRRORS) -> list[dict]:
    """All elements in a box from the first of the servers in `ask` that has some, each (type, id) once.

    An empty answer stands if a second server agrees, if the box is known to be open water, or if no server is left: a
    part of an empty box is empty too, so splitting cannot help. A box that every server fails for is asked for in
    quarters, up to MOST_SPLITS times over.
    """
    empty = 0
    for server in ask:
        try:
            found = json.loads(server(water_query(box))).get("elements") or []
        except Exception:  # the next server may answer
            continue
        if found:
            return found
        empty += 1
        if empty >= mirrors or ocean >= OCEAN:
            return []
    if empty:
        return []
    if depth >= MOST_SPLITS:
        raise RuntimeError(f"no server answers for {box}")
    out: dict[tuple, dict] = {}
    for part in quadrants(*box):
        for e in elements(part, ask, ocean, depth + 1, mirrors):
            out.setdefault((e.get("type"), e.get("id")), e)
    return list(out.values())
