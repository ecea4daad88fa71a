"""Polygon layouts as text expressions, rendered for either SQL dialect.

A layout is nested lists ending in ``(x, y)`` offsets from a base point ``x0, y0``.
"""

from __future__ import annotations

SQUARE = [[[("0e0", "0e0"), ("15e-2", "0e0"), ("15e-2", "15e-2"), ("0e0", "15e-2"), ("0e0", "0e0")]]]
CORNER = [
    [
        [
            ("0e0", "0e0"),
            ("15e-2", "0e0"),
            ("15e-2", "7e-2"),
            ("7e-2", "7e-2"),
            ("7e-2", "15e-2"),
            ("0e0", "15e-2"),
            ("0e0", "0e0"),
        ]
    ]
]
FRAME = [
    [
        SQUARE[0][0],
        [("4e-2", "4e-2"), ("1e-1", "4e-2"), ("1e-1", "1e-1"), ("4e-2", "1e-1"), ("4e-2", "4e-2")],
    ]
]
TWINS = [
    [[("0e0", "0e0"), ("6e-2", "0e0"), ("6e-2", "15e-2"), ("0e0", "15e-2"), ("0e0", "0e0")]],
    [[("9e-2", "0e0"), ("15e-2", "0e0"), ("15e-2", "15e-2"), ("9e-2", "15e-2"), ("9e-2", "0e0")]],
]
WIDE = [[[("-1e-1", "0e0"), ("15e-2", "0e0"), ("15e-2", "15e-2"), ("-1e-1", "1e-1"), ("-1e-1", "0e0")]]]
OPEN_RING = [[[("0e0", "0e0"), ("15e-2", "0e0"), ("15e-2", "15e-2"), ("0e0", "15e-2")]]]
SHORT_RING = [[[("0e0", "0e0"), ("15e-2", "0e0"), ("0e0", "0e0")]]]


def render(layout: list, spark: bool) -> str:
    """The layout as a nested array expression over ``x0`` and ``y0``."""

    def array(items: list[str]) -> str:
        return f"array({', '.join(items)})" if spark else f"[{', '.join(items)}]"

    def walk(node) -> str:
        if isinstance(node, tuple):
            return array([f"x0 + {node[0]}", f"y0 + {node[1]}"])
        return array([walk(child) for child in node])

    return walk(layout)


def by_shape(layouts: list[list], spark: bool) -> str:
    """A CASE over the ``shape`` column."""
    cases = " ".join(f"when {i} then {render(layout, spark)}" for i, layout in enumerate(layouts))
    return f"case shape {cases} end"


DISTRICTS = [SQUARE, CORNER, FRAME, TWINS, WIDE]
PARCELS = [SQUARE, CORNER, FRAME, TWINS, OPEN_RING, SHORT_RING]
