"""Image geometry as column expressions. Every product keeps the order in which doubles are rounded."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _whole(x: Column) -> Column:
    return F.floor(x).cast("int")


def resize_and_pad(w: Column, h: Column, target_h: int, target_w: int) -> dict[str, Column]:
    """Largest size of equal aspect inside the target, and where it is pasted.

    Null or non-positive dimensions give null.
    """
    ok = (w >= 1) & (h >= 1)
    scale = F.least(F.lit(target_w) / w, F.lit(target_h) / h)
    nw, nh = _whole(w * scale), _whole(h * scale)
    out = {"new_w": nw, "new_h": nh, "pad_left": _whole((target_w - nw) / 2), "pad_top": _whole((target_h - nh) / 2)}
    return {k: F.when(ok, v) for k, v in out.items()}


def center_crop(w: Column, h: Column, target_h: int, target_w: int) -> dict[str, Column]:
    """Smallest size of equal aspect that covers the target, and the corner of the crop."""
    ok = (w >= 1) & (h >= 1)
    scale = F.greatest(F.lit(target_w) / w, F.lit(target_h) / h)
    nw, nh = _whole(w * scale), _whole(h * scale)
    out = {"new_w": nw, "new_h": nh, "crop_left": _whole((nw - target_w) / 2), "crop_top": _whole((nh - target_h) / 2)}
    return {k: F.when(ok, v) for k, v in out.items()}


def preserve_aspect(w: Column, h: Column, longest: int) -> dict[str, Column]:
    """Size after downscaling to at most ``longest``; never larger than before, never below 1."""
    ok = (w >= 1) & (h >= 1)
    scale = F.least(F.lit(longest) / w, F.lit(longest) / h)
    small = scale < 1.0
    return {
        "actual_w": F.when(ok, F.when(small, F.greatest(F.lit(1), _whole(w * scale))).otherwise(w)),
        "actual_h": F.when(ok, F.when(small, F.greatest(F.lit(1), _whole(h * scale))).otherwise(h)),
    }


def aspect_bounds(buckets: int) -> list[float]:
    """The ``buckets`` - 1 inner bounds of width / height, evenly spaced in logarithm from 1/2 to 2, in single precision."""
    import numpy as np

    low, high = math.log(0.5), math.log(2.0)
    return [float(np.float32(math.exp(low + i * (high - low) / buckets))) for i in range(1, buckets)]


def aspect_bucket(w: Column, h: Column, buckets: int) -> Column:
    """Index of the first bound above width / height, else the last bucket; null for height 0 or null."""
    ratio = (w / h).cast("float")
    out = F.lit(buckets - 1)
    for i, bound in reversed(list(enumerate(aspect_bounds(buckets)))):
        out = F.when(ratio < F.lit(bound).cast("float"), F.lit(i)).otherwise(out)
    return F.when(h != 0, out)


def normalise(x: Column, mean: float, std: float) -> Column:
    """Stored byte to normalised value, as one product and one sum."""
    return x * F.lit(1.0 / (255.0 * std)) + F.lit(-mean / std)
