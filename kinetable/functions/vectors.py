"""Vector columns: slices, unit and rotation conversion, named conversions.

Vectors are ARRAY<DOUBLE> or ARRAY<FLOAT>; the arithmetic is in double.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

Conversion = Callable[[Column], Column]

# closer than this to a right angle counts as gimbal lock
GIMBAL_EPS = 1e-7


def vector_slice(v: Column, start: int, stop: int) -> Column:
    """Elements [start, stop), shorter past the end, negative bounds from the end: like a Python slice."""
    if start >= 0 and stop >= 0:
        return F.slice(v, start + 1, max(stop - start, 0))

    def place(bound: int) -> Column:
        return F.greatest(F.size(v) + bound, F.lit(0)) if bound < 0 else F.lit(bound)

    return F.slice(v, place(start) + 1, F.greatest(place(stop) - place(start), F.lit(0)))


def as_double(v: Column) -> Column:
    return v.cast("array<double>")


def scale(divisor: float) -> Conversion:
    return lambda v: F.transform(as_double(v), lambda x: x / F.lit(float(divisor)))


def cm_to_m(v: Column) -> Column:
    return scale(100)(v)


def mm_to_m(v: Column) -> Column:
    return scale(1000)(v)


def degree_to_rad(v: Column) -> Column:
    return F.transform(as_double(v), F.radians)


def _parts(v: Column, n: int) -> list[Column]:
    v = as_double(v)
    return [v[i] for i in range(n)]


def _dot(a: list[Column], b: list[Column]) -> Column:
    total = a[0] * b[0]
    for x, y in zip(a[1:], b[1:], strict=True):
        total = total + x * y
    return total


def _cross(a: list[Column], b: list[Column]) -> list[Column]:
    return [a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]]


def _positive(value: Column, what: str) -> Column:
    return F.when(value > 0, value).otherwise(F.raise_error(F.lit(f"{what} has zero norm")).cast("double"))


def _euler(roll: Column, locked_roll: Column, sin_pitch: Column, yaw: Column) -> Column:
    """Extrinsic xyz angles; in gimbal lock the third angle is 0."""
    pitch = F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), sin_pitch)))
    locked = F.abs(F.abs(pitch) - F.lit(math.pi / 2)) < GIMBAL_EPS
    return F.array(F.when(locked, locked_roll).otherwise(roll), pitch, F.when(locked, F.lit(0.0)).otherwise(yaw))


# The two-argument arctangent does not change when both arguments are scaled by a positive
# number, so the norms are left out of it. That keeps the expressions small enough for
# generated code to be compiled as one method.


def quat_to_euler(v: Column, order: str = "xyzw") -> Column:
    """Quaternion of any norm to extrinsic xyz Euler angles."""
    q = dict(zip(order, _parts(v, 4), strict=True))
    x, y, z, w = (q[k] for k in "xyzw")
    n2 = _dot([x, y, z, w], [x, y, z, w])
    return _euler(
        F.atan2(2 * (y * z + w * x), n2 - 2 * (x * x + y * y)),
        F.atan2(2 * (w * x - y * z), n2 - 2 * (x * x + z * z)),
        2 * (w * y - x * z) / _positive(n2, "quaternion"),
        F.atan2(2 * (x * y + w * z), n2 - 2 * (y * y + z * z)),
    )


def quat_xyzw_to_euler(v: Column) -> Column:
    return quat_to_euler(v, "xyzw")


def quat_wxyz_to_euler(v: Column) -> Column:
    return quat_to_euler(v, "wxyz")


def rot6d_to_matrix(v: Column) -> Column:
    """6-D rotation to a 3x3 matrix (array of rows) whose columns are the orthonormal axes."""
    a = _parts(v, 6)
    first, second = a[:3], a[3:]
    n2, along = _dot(first, first), _dot(first, second)
    cross = _cross(first, second)
    n = F.sqrt(_positive(n2, "first rotation axis"))
    area = F.sqrt(_positive(_dot(cross, cross), "second rotation axis"))
    x = [p / n for p in first]
    y = [(n2 * s - along * p) / (n * area) for p, s in zip(first, second, strict=True)]
    z = [c / area for c in cross]
    return F.array(*[F.array(x[i], y[i], z[i]) for i in range(3)])


def rot6d_to_euler(v: Column) -> Column:
    """Euler angles of ``rot6d_to_matrix``."""
    a = _parts(v, 6)
    first, second = a[:3], a[3:]
    n2, along = _dot(first, first), _dot(first, second)
    cross = _cross(first, second)
    n = F.sqrt(_positive(n2, "first rotation axis"))
    roll = F.when(
        _dot(cross, cross) > 0, F.atan2(n2 * second[2] - along * first[2], n * cross[2])
    ).otherwise(F.raise_error(F.lit("second rotation axis has zero norm")).cast("double"))
    return _euler(
        roll,
        F.atan2(-n * cross[1], n2 * second[1] - along * first[1]),
        -first[2] / n,
        F.atan2(first[1], first[0]),
    )


_CONVERSIONS: dict[str, Conversion] = {
    "mm2m": mm_to_m,
    "cm2m": cm_to_m,
    "degree2rad": degree_to_rad,
    "quat_xyzw_2_rot_xyz": quat_xyzw_to_euler,
    "quat_wxyz_2_rot_xyz": quat_wxyz_to_euler,
    "rot6d_to_euler_xyz": rot6d_to_euler,
}


def register_conversion(name: str, fn: Conversion) -> None:
    """Make ``fn`` (Column -> Column) usable by name in a feature config."""
    _CONVERSIONS[name] = fn


def conversion(name: str | None) -> Conversion | None:
    """The registered conversion, or None: unknown names pass values through."""
    return _CONVERSIONS.get(name) if name else None
