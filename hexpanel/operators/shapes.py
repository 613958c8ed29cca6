"""The 22 shape features of a parcel, by named makers: column expressions over measures that one pass over its rings
gives."""

from __future__ import annotations

import logging
import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexpanel.functions import geometry as G
from hexpanel.operators.overlay import half_even, round_floats

log = logging.getLogger(__name__)
_none_if_zero = lambda c: F.nullif(c, F.lit(0.0))


def size_scale(m: Column) -> dict[str, Column]:
    a, p = m["area"], m["length"]
    return {"area_ha": half_even(a / 1e4, 4), "perimeter_m": half_even(p, 1), "log_area": F.ln(a), "log_perimeter": F.ln(p), "mean_width": F.try_divide(2 * a, p)}


def elongation(m: Column) -> dict[str, Column]:
    return {"elongation_mrr": F.try_divide(m["major"], m["minor"]), "orientation_deg": m["angle"], "aspect_ratio_bbox": F.try_divide(m["x1"] - m["x0"], m["y1"] - m["y0"])}


def compactness(m: Column) -> dict[str, Column]:
    a, p = m["area"], m["length"]
    return {"ipq": F.try_divide(4 * math.pi * a, p * p), "rectangularity": F.try_divide(a, m["major"] * m["minor"]), "solidity": F.try_divide(a, m["hull_area"])}


def complexity(m: Column) -> dict[str, Column]:
    a, p = m["area"], m["length"]
    return {"complexity_index": F.try_divide(p, _none_if_zero(2 * F.sqrt(math.pi * a))), "vertex_density": F.try_divide(m["vertices"], p)}


def inertia(m: Column) -> dict[str, Column]:
    """Eigenvalues of the covariance of a uniform point on the exterior: what a random sample of boundary points tends to,
    without the sampling."""
    mid, half = (m["xx"] + m["yy"]) / 2, F.sqrt(F.pow((m["xx"] - m["yy"]) / 2, 2) + m["xy"] * m["xy"])
    return {"inertia_ratio": F.try_divide(mid + half, mid - half), "inertia_major": mid + half, "inertia_minor": mid - half}


def convexity(m: Column) -> dict[str, Column]:
    a, h = m["area"], m["hull_area"]
    return {"convexity_deficit_len": m["hull_length"] - m["length"], "convexity_deficit_area": h - a, "convexity_deficit_ratio": F.try_divide(h - a, h)}


def envelope(m: Column) -> dict[str, Column]:
    """Radius from the centroid to the farthest vertex, and the circle of it."""
    a, r = m["area"], m["radius"]
    return {"min_circle_radius": r, "area_to_circle_ratio": F.try_divide(a, math.pi * r * r), "circle_area_excess": math.pi * r * r - a}


MAKERS: dict[str, Callable[[Column], dict[str, Column]]] = {
    "SizeScaleFeatures": size_scale, "ElongationOrientationFeatures": elongation, "CompactnessCircularityFeatures": compactness, "EdgeComplexityFeatures": complexity,
    "MomentInertiaFeatures": inertia, "EdgeContextFeatures": convexity, "ExtremeEnvelopeFeatures": envelope,
}
METRIC = set(MAKERS) - {"EdgeComplexityFeatures", "MomentInertiaFeatures"}


def features(df: DataFrame, *, geometry: str = "geometry", keys: Sequence[str] = ("iddzialki", "year"), makers: Sequence[str] | None = None, srid: int | None = 2180, decimals: int | None = None) -> DataFrame:
    """Keys, then the makers' features by name; rows without a geometry are left out. Unknown makers are skipped with a
    warning, and so is a maker whose expressions can't be built."""
    found: dict[str, Column] = {}
    g, m = F.col(geometry), F.col("_measures")
    for name in makers or MAKERS:
        if name not in MAKERS:
            log.warning("unknown feature maker %s", name)
            continue
        if name in METRIC:
            G.metric_srid(srid)
        try:
            found |= MAKERS[name](m)
        except Exception:
            log.exception("feature maker %s failed", name)
    out = df.where(g.isNotNull() & (F.size(g) > 0)).select(*keys, G.measures(g).alias("_measures")).select(*keys, *(found[c].alias(c) for c in sorted(found)))
    return out if decimals is None else round_floats(out, decimals, keys)
