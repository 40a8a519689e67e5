"""Column functions over a vector field with true-east and true-north components."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Glyph bands (arrow spacing and raster pixel in metres), the speed at which a
# shaft fills 80 percent of the spacing, and the colour range in m/s.
GLYPH_BANDS = ((160000.0, 4096.0), (40000.0, 1024.0))
GLYPH_FILL = 0.8
GLYPH_MAX_SPEED = 25.0
GLYPH_CLIM = (0.0, 20.0)


def valid_vector(u: Column, v: Column) -> Column:
    """Both components present and finite."""
    def finite(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))
    return finite(u) & finite(v)


def speed(u: Column, v: Column) -> Column:
    return F.hypot(u, v)


def dir_to(u: Column, v: Column) -> Column:
    """Compass bearing the flow goes toward, clockwise from true north."""
    return F.pmod(F.degrees(F.atan2(u, v)), F.lit(360.0))


def math_angle(u: Column, v: Column) -> Column:
    """Angle counter-clockwise from east."""
    return F.pmod(F.degrees(F.atan2(v, u)), F.lit(360.0))


def map_vector(u: Column, v: Column, x: Column, y: Column) -> tuple[Column, Column]:
    """Components along the map axes; true north is the direction to the map origin."""
    r = F.hypot(x, y)
    r = F.when(r == 0, F.lit(1.0)).otherwise(r)
    north_x, north_y = -x / r, -y / r
    return u * north_y + v * north_x, v * north_y - u * north_x


def glyph_segment(u: Column, v: Column, x: Column, y: Column, spacing: Column) -> Column:
    """Tail, head and colour speed of an arrow glyph for one zoom band."""
    ex, ny = map_vector(u, v, x, y)
    scale = F.lit(GLYPH_FILL) * spacing / F.lit(GLYPH_MAX_SPEED)
    lo, hi = GLYPH_CLIM
    return F.struct(x.alias("x0"), y.alias("y0"), (x + ex * scale).alias("x1"),
                    (y + ny * scale).alias("y1"),
                    F.least(F.greatest(speed(u, v), F.lit(lo)), F.lit(hi)).alias("colour_speed"))
