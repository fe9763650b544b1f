"""Camera geometry as column expressions: rotations, poses, intrinsics, projection."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

Vector = tuple[Column, Column, Column]
Matrix = tuple[Vector, Vector, Vector]


def dot(a: Vector, b: Vector) -> Column:
    return a[0] * b[0] + a[1] * b[1] + a[2] * b[2]


def cross(a: Vector, b: Vector) -> Vector:
    return (a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0])


def norm(a: Vector) -> Column:
    return F.sqrt(dot(a, a))


def apply(m: Matrix, v: Vector) -> Vector:
    return (dot(m[0], v), dot(m[1], v), dot(m[2], v))


def transpose(m: Matrix) -> Matrix:
    return tuple(tuple(m[j][i] for j in range(3)) for i in range(3))  # type: ignore[return-value]


def rotation(x: Column, y: Column, z: Column, w: Column) -> Matrix:
    """Rotation matrix of a quaternion in x, y, z, w order, of any length; the identity for zero."""
    n = x * x + y * y + z * z + w * w
    s = F.when(n == 0, F.lit(0.0)).otherwise(2 / n)
    one = F.lit(1.0)
    return (
        (one - s * (y * y + z * z), s * (x * y - w * z), s * (x * z + w * y)),
        (s * (x * y + w * z), one - s * (x * x + z * z), s * (y * z - w * x)),
        (s * (x * z - w * y), s * (y * z + w * x), one - s * (x * x + y * y)),
    )


def quaternion(m: Matrix) -> tuple[Column, Column, Column, Column]:
    """Unit quaternion of a rotation matrix, w first and not negative; found from its largest part."""
    squares = [
        1 + m[0][0] + m[1][1] + m[2][2],
        1 + m[0][0] - m[1][1] - m[2][2],
        1 - m[0][0] + m[1][1] - m[2][2],
        1 - m[0][0] - m[1][1] + m[2][2],
    ]  # of four times each part squared
    off = {(0, 1): m[2][1] - m[1][2], (0, 2): m[0][2] - m[2][0], (0, 3): m[1][0] - m[0][1], (1, 2): m[0][1] + m[1][0], (1, 3): m[0][2] + m[2][0], (2, 3): m[1][2] + m[2][1]}
    most = F.greatest(*squares)

    def part(i: int) -> Column:
        found = None
        for k in range(4):
            root = F.sqrt(F.greatest(squares[k], F.lit(1e-12)))
            value = root / 2 if k == i else off[min(i, k), max(i, k)] / (2 * root)
            found = F.when(squares[k] == most, value) if found is None else found.when(squares[k] == most, value)
        return found

    q = [part(i) for i in range(4)]
    sign = F.when(q[0] < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    return tuple(c * sign for c in q)  # type: ignore[return-value]


def camera_rotation(m: Matrix) -> Matrix:
    """From a camera that looks along -Z with +Y up to one that looks along +Z with +Y down."""
    return tuple((row[0], -row[1], -row[2]) for row in m)  # type: ignore[return-value]


def inverse_pose(m: Matrix, t: Vector) -> tuple[Matrix, Vector]:
    """World-to-camera rotation and translation of a camera-to-world pose."""
    back = transpose(m)
    moved = apply(back, t)
    return back, (-moved[0], -moved[1], -moved[2])


def focal(width: Column | float, field_deg: Column | float) -> Column:
    """Focal length in pixels of a horizontal field of view in degrees."""
    field = field_deg if isinstance(field_deg, Column) else F.lit(float(field_deg))
    return (width / F.lit(2.0) if isinstance(width, Column) else F.lit(width / 2.0)) / F.tan(F.radians(field) / 2)


def vertical_field(width: Column, height: Column, field_deg: Column) -> Column:
    """Vertical field of view (degrees) of square pixels."""
    return F.degrees(2 * F.atan(F.tan(F.radians(field_deg) / 2) * height / width))


def unproject(u: Column, v: Column, depth: Column, fx: Column, fy: Column, cx: Column, cy: Column) -> Vector:
    return ((u - cx) * depth / fx, (v - cy) * depth / fy, depth)


def camera_parameters(model: str, fx: Column, fy: Column, cx: Column, cy: Column) -> Column:
    """Parameters of a camera model as an array."""
    mean = 0.5 * (fx + fy)
    if model == "PINHOLE":
        return F.array(fx, fy, cx, cy)
    if model == "SIMPLE_PINHOLE":
        return F.array(mean, cx, cy)
    if model == "SIMPLE_RADIAL":
        return F.array(mean, cx, cy, F.lit(0.0))
    raise ValueError(f"unknown camera model: {model}")


def turned(yaw: Column, pitch: Column, roll: Column) -> tuple[Column, Column, Column, Column]:
    """Quaternion (x, y, z, w) of a yaw about +Y, then a pitch about the turned right axis, then a roll about the turned forward axis (-Z)."""
    one = _axis(yaw, 1, 1.0)
    return quaternion_product(quaternion_product(one, _axis(pitch, 0, 1.0)), _axis(roll, 2, -1.0))


def _axis(angle: Column, axis: int, sign: float) -> tuple[Column, Column, Column, Column]:
    parts = [F.lit(0.0), F.lit(0.0), F.lit(0.0)]
    parts[axis] = sign * F.sin(angle / 2)
    return (parts[0], parts[1], parts[2], F.cos(angle / 2))


def quaternion_product(a, b):
    """Hamilton product in x, y, z, w order."""
    ax, ay, az, aw = a
    bx, by, bz, bw = b
    return (
        aw * bx + ax * bw + ay * bz - az * by,
        aw * by - ax * bz + ay * bw + az * bx,
        aw * bz + ax * by - ay * bx + az * bw,
        aw * bw - ax * bx - ay * by - az * bz,
    )


def aligned_to(d: Vector) -> Matrix:
    """Rotation that takes +Z to the direction ``d``."""
    n = norm(d) + 1e-9
    x, y, z = (c / n for c in d)
    near = lambda a, b: F.abs(a - b) <= 1e-8 + 1e-5 * abs(b)
    same = near(x, 0.0) & near(y, 0.0) & near(z, 1.0)
    opposite = near(x, 0.0) & near(y, 0.0) & near(z, -1.0)
    vx, vy = -y, x  # the cross product of +Z with d lies in the XY plane
    k = (1 - z) / (vx * vx + vy * vy + 1e-12)
    general = ((1 - vy * vy * k, vx * vy * k, vy), (vx * vy * k, 1 - vx * vx * k, -vx), (-vy, vx, 1 - (vx * vx + vy * vy) * k))
    flat = lambda i, j, sign: F.lit(float((i == j) * (sign[i])))
    return tuple(
        tuple(F.when(same, flat(i, j, (1, 1, 1))).when(opposite, flat(i, j, (1, -1, -1))).otherwise(general[i][j]) for j in range(3)) for i in range(3)
    )  # type: ignore[return-value]


FIELD_LIMITS = (30.0, 120.0)
HALF_TURN = math.pi
