"""SQL expressions on arrays of joint readings.

They are texts for ``selectExpr`` / ``F.expr``: one parse per expression instead
of one JVM round trip per operator. Where a formula only concerns the first
twelve joints it is spelled out per joint, which Spark compiles; higher-order
functions are left to the rare arrays with NaN or NULL readings or more joints.
"""

from __future__ import annotations

from collections.abc import Sequence

# Mechanical range per joint in radians, lower and upper.
JOINT_MIN = [-3.14, -1.57, -3.14, -2.09, -3.14, -1.57, -3.14, -1.0, -1.0, 0.0, 0.0, 0.0]
JOINT_MAX = [3.14, 1.57, 3.14, 0.17, 3.14, 1.57, 3.14, 1.0, 1.0, 1.5, 1.5, 1.5]

JOINTS = 12
NAN = "double('NaN')"
NO_DOUBLES = "cast(array() AS array<double>)"


def number(value: float) -> str:
    return f"{float(value)!r}D"


# Squared changes are added as decimals: the sum is exact, so it does not depend
# on how Spark splits the rows, and the RMS flag rounds the same way at any size.
SQUARES = "decimal(32,18)"
SQUARES_SUM = "decimal(38,18)"
NO_SQUARES = f"cast(0 AS {SQUARES})"


def square(change: str) -> str:
    """A squared change of two readings, NULL if one is missing."""
    return f"cast(({change}) * ({change}) AS {SQUARES})"


def exact_sum(terms: Sequence[str]) -> str:
    """Decimal ``terms`` added without losing a digit."""
    total = terms[0]
    for term in terms[1:]:
        total = f"cast({total} + {term} AS {SQUARES})"
    return total


def readings(values: str) -> str:
    """A missing array is empty, a NaN reading is NULL."""
    return (
        f"CASE WHEN {values} IS NULL THEN {NO_DOUBLES}"
        f" WHEN array_contains({values}, {NAN})"
        f" THEN transform({values}, v -> CASE WHEN NOT isnan(v) THEN v END)"
        f" ELSE {values} END"
    )


def count_null(values: str) -> str:
    """NULL readings of an array without NaN.

    Searching for a value that is not there answers false only when every
    element is known, so a full array is recognised in one native pass.
    """
    return (
        f"CASE WHEN array_contains({values}, {NAN}) = false THEN 0"
        f" ELSE size(filter({values}, v -> v IS NULL)) END"
    )


def per_joint(term: str, joints: Sequence[int] = range(JOINTS)) -> str:
    """``term`` summed over the joints; ``{j}`` stands for the joint number."""
    return " + ".join(f"({term.format(j=j)})" for j in joints)


def clean(values: str, digits: int) -> str:
    """NaN to NULL, everything else rounded."""
    return (
        f"transform({values}, v -> CASE WHEN NOT isnan(v)"
        f" THEN round(cast(v AS double), {digits}) END)"
    )


def clip_joints(
    positions: str,
    low: Sequence[float] = tuple(JOINT_MIN),
    high: Sequence[float] = tuple(JOINT_MAX),
) -> str:
    """Positions limited to the mechanical range; NULL readings stay NULL."""
    limited = ", ".join(
        f"CASE WHEN get({positions}, {j}) IS NOT NULL THEN"
        f" least(greatest(cast(get({positions}, {j}) AS double), {number(lo)}), {number(hi)}) END"
        for j, (lo, hi) in enumerate(zip(low, high))
    )
    return (
        f"CASE WHEN {positions} IS NOT NULL"
        f" THEN slice(array({limited}), 1, least(size({positions}), {len(low)})) END"
    )


def ee_pose(positions: str) -> str:
    """[x, y, z, qx, qy, qz, qw] approximated from the first five joints."""
    p = [f"cast(get({positions}, {j}) AS double)" for j in range(5)]
    q = [f"sin({p[j]} / 2) * 0.1D" for j in (2, 3, 4)]
    rest = "1D" + "".join(f" - ({v}) * ({v})" for v in q)
    pose = [
        f"0.3D + 0.2D * sin({p[0]}) * cos({p[1]})",
        f"0.1D + 0.2D * sin({p[1]})",
        f"0.8D + 0.15D * cos({p[0]})",
        *q,
        f"sqrt(CASE WHEN {rest} < 0 THEN 0D ELSE {rest} END)",
    ]
    return f"array({', '.join(f'round({v}, 6)' for v in pose)})"
