"""Building footprints to WGS 84 well-known binary.

Binary encoding has no built-in column function, so this is the package's one Arrow UDF. Each
row says by its own shape whether it is text or hexadecimal binary; anything else fails the job
rather than yield a silently empty column. All the vertices of a batch are projected in one
vectorised call per coordinate system.
"""

from __future__ import annotations

import math
import re
import struct

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrier.functions import projection as pj

# Geometry codes of well-known binary.
KINDS = {
    "POINT": 1,
    "LINESTRING": 2,
    "POLYGON": 3,
    "MULTIPOINT": 4,
    "MULTILINESTRING": 5,
    "MULTIPOLYGON": 6,
}
PART_OF = {4: 1, 5: 2, 6: 3}
WKT_SHAPE = r"^\s*[A-Za-z][^(]*(\(|EMPTY\s*$)"
HEX_SHAPE = r"^\s*([0-9A-Fa-f]{2})+\s*$"

# A geometry is (kind, width, parts): parts are vertex arrays for kinds 1 to 3 and geometries
# for the collections; width is 2, or 3 where heights are present.


def _ring(text: str, width: int) -> np.ndarray:
    return np.array(text.replace(",", " ").split(), dtype=float).reshape(-1, width)


def _groups(text: str) -> list[str]:
    """The contents of the outermost parentheses of ``text``."""
    found, depth, start = [], 0, 0
    for match in re.finditer(r"[()]", text):
        if match.group() == "(":
            depth += 1
            if depth == 1:
                start = match.end()
        else:
            depth -= 1
            if depth == 0:
                found.append(text[start : match.start()])
    if depth:
        raise ValueError(f"unbalanced geometry text: {text[:80]!r}")
    return found


def read_wkt(text: str):
    match = re.match(r"\s*([A-Za-z]+)\s*(ZM|Z|M)?\s*(EMPTY)?", text, re.IGNORECASE)
    kind = KINDS.get(match.group(1).upper()) if match else None
    dims = (match.group(2) or "").upper() if match else ""
    if kind is None or dims not in ("", "Z"):
        raise ValueError(f"unsupported geometry: {text[:80]!r}")
    width = 3 if dims else 2
    if match.group(3):
        return kind, width, [np.full((1, width), np.nan)] if kind == 1 else []
    body = _groups(text[match.end() :])
    if len(body) != 1:
        raise ValueError(f"unreadable geometry: {text[:80]!r}")
    body = body[0]
    if kind in (1, 2):
        return kind, width, [_ring(body, width)]
    if kind == 3:
        return kind, width, [_ring(g, width) for g in _groups(body)]
    if kind == 4:
        points = _ring(body.replace("(", " ").replace(")", " "), width)
        return kind, width, [(1, width, [p.reshape(1, width)]) for p in points]
    if kind == 5:
        return kind, width, [(2, width, [_ring(g, width)]) for g in _groups(body)]
    polygons = [[_ring(r, width) for r in _groups(g)] for g in _groups(body)]
    return kind, width, [(3, width, rings) for rings in polygons]


def read_wkb(data: bytes, offset: int = 0):
    """Returns the geometry and the offset just after it."""
    order = "<" if data[offset] == 1 else ">"
    (code,) = struct.unpack_from(order + "I", data, offset + 1)
    offset += 5
    width = 2
    if code & 0x20000000:  # embedded reference system: skip it
        offset += 4
    if code & 0x40000000 or (code & 0xFFFF) >= 2000:
        raise ValueError("measured geometries are not supported")
    if code & 0x80000000 or (code & 0xFFFF) >= 1000:
        width = 3
    kind = (code & 0xFFFF) % 1000

    def vertices(count: int, at: int):
        array = np.frombuffer(data, dtype=order + "f8", count=count * width, offset=at)
        return array.reshape(count, width).astype(float), at + 8 * count * width

    if kind == 1:
        points, offset = vertices(1, offset)
        return (kind, width, [points]), offset
    if kind not in (2, 3, 4, 5, 6):
        raise ValueError(f"unsupported geometry code {code}")
    (count,) = struct.unpack_from(order + "I", data, offset)
    offset += 4
    if kind == 2:
        points, offset = vertices(count, offset)
        return (kind, width, [points]), offset
    parts = []
    for _ in range(count):
        if kind == 3:
            (size,) = struct.unpack_from(order + "I", data, offset)
            part, offset = vertices(size, offset + 4)
        else:
            part, offset = read_wkb(data, offset)
        parts.append(part)
    return (kind, width, parts), offset


def write_wkb(geometry) -> bytes:
    kind, width, parts = geometry
    head = struct.pack("<BI", 1, kind + (1000 if width == 3 else 0))
    if kind == 1:
        return head + parts[0].astype("<f8").tobytes()
    if kind == 2:
        points = parts[0] if parts else np.empty((0, width))
        return head + struct.pack("<I", len(points)) + points.astype("<f8").tobytes()
    body = [
        struct.pack("<I", len(p)) + p.astype("<f8").tobytes() if kind == 3 else write_wkb(p)
        for p in parts
    ]
    return head + struct.pack("<I", len(parts)) + b"".join(body)


def _leaves(geometry) -> list[np.ndarray]:
    kind, _, parts = geometry
    return [leaf for p in parts for leaf in _leaves(p)] if kind in PART_OF else parts


def lon_lat_arrays(srid: int, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same closed forms as the column version, over arrays."""
    if srid in pj.CONIC:
        c = pj.cone(srid)
        side = math.copysign(1.0, c.n)
        u, v = side * (x - c.east), side * (c.rho0 - (y - c.north))
        chi = np.pi / 2 - 2 * np.arctan((side * np.hypot(u, v) / c.scale) ** (1 / c.n))
        lon = np.degrees(np.arctan2(u, v) / c.n) + c.lon0
    elif srid in pj.MERCATOR:
        lon0, north = pj.MERCATOR[srid]
        radius = pj.SCALE * pj.RECTIFYING
        xi, eta = (y - north) / radius, (x - pj.FALSE_EAST) / radius
        steps = [(2 * k, b) for k, b in enumerate(pj.INVERSE_KRUGER, start=1)]
        xi1 = xi - sum(b * np.sin(m * xi) * np.cosh(m * eta) for m, b in steps)
        eta1 = eta - sum(b * np.cos(m * xi) * np.sinh(m * eta) for m, b in steps)
        chi = np.arcsin(np.sin(xi1) / np.cosh(eta1))
        lon = np.degrees(np.arctan2(np.sinh(eta1), np.cos(xi1))) + lon0
    else:
        raise ValueError(f"no parameters on record for coordinate system {srid}")
    lat = chi + sum(d * np.sin(2 * k * chi) for k, d in enumerate(pj.TO_GEODETIC, start=1))
    return lon, np.degrees(lat)


def project_batch(geometries: list, srid: int) -> None:
    """Projects every vertex of the batch, in place."""
    leaves = [leaf for g in geometries for leaf in _leaves(g)]
    if not leaves:
        return
    lon, lat = lon_lat_arrays(
        srid, np.concatenate([a[:, 0] for a in leaves]), np.concatenate([a[:, 1] for a in leaves])
    )
    at = 0
    for leaf in leaves:
        leaf[:, 0], leaf[:, 1] = lon[at : at + len(leaf)], lat[at : at + len(leaf)]
        at += len(leaf)


def _encode(geom: pd.Series, is_text: pd.Series, srid: pd.Series) -> pd.Series:
    out = pd.Series([None] * len(geom), dtype=object)
    geom, is_text, srid = (s.reset_index(drop=True) for s in (geom, is_text, srid))
    present = geom.notna()
    for code in srid[present].unique():
        rows = np.flatnonzero(present & (srid == code))
        shapes = [
            read_wkt(geom[i]) if is_text[i] else read_wkb(bytes.fromhex(geom[i].strip()))[0]
            for i in rows
        ]
        project_batch(shapes, int(code))
        for i, shape in zip(rows, shapes):
            out[i] = write_wkb(shape)
    return out


def _udf():
    return F.pandas_udf(_encode, T.BinaryType())


def footprint_wkb(geom: Column, srid: Column) -> Column:
    """Text or hexadecimal footprint in a metric system to WGS 84 binary; NULL stays NULL."""
    is_text = geom.rlike("(?i)" + WKT_SHAPE)
    refusal = F.raise_error(F.concat(F.lit("unknown footprint format: "), F.substring(geom, 1, 80)))
    checked = F.when(is_text | geom.rlike(HEX_SHAPE), geom).when(geom.isNotNull(), refusal.cast("string"))
    return _udf()(checked, is_text, srid)


def add_footprints(df: DataFrame, geom: str, dept: str, out: str = "geom", srid: int | None = None) -> DataFrame:
    """Adds the encoded footprint, read in ``srid`` or else in the system of the row's territory.

    Without a forced system, a footprint of an unknown territory fails the job.
    """
    if srid is not None:
        return df.withColumn(out, footprint_wkb(F.col(geom), F.lit(srid)))
    params = F.broadcast(pj.parameters(df.sparkSession).select("_territory", "srid"))
    refusal = F.raise_error(
        F.concat(F.lit("unknown territory of a footprint: "), F.coalesce(F.col(dept), F.lit("NULL")))
    )
    system = F.coalesce(F.col("srid"), F.when(F.col(geom).isNotNull(), refusal.cast("int")))
    columns = df.columns
    return df.join(params, F.col(dept) == F.col("_territory"), "left").select(
        *columns, footprint_wkb(F.col(geom), system).alias(out)
    )
