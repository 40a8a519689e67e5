"""Radiometric column functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Calibration convention to the element of the annotation that holds its table.
LUT_ELEMENTS = {"sigma0": "sigmaNought", "beta0": "betaNought", "gamma0": "gamma"}


def check_convention(calibration: str) -> str:
    if calibration not in LUT_ELEMENTS:
        raise ValueError(f"unknown calibration {calibration!r}; valid: {sorted(LUT_ELEMENTS)}")
    return LUT_ELEMENTS[calibration]


def calibrate_db(dn: Column, k: Column) -> Column:
    """Backscatter in decibels from a digital number; no signal (dn <= 0) is null."""
    return F.when(dn > 0, 10 * F.log10((dn * dn) / (k * k)))


def db_to_linear(db: Column) -> Column:
    return F.pow(F.lit(10.0), db / 10)


def sigma_to_gamma(db: Column, theta: Column) -> Column:
    """Gamma from sigma in dB; theta is the incidence angle in radians."""
    return db - 10 * F.log10(F.cos(theta))


def rescale(value: Column, lo: float = -30.0, hi: float = 10.0) -> Column:
    """Display stretch of a value to 0..1, clamped."""
    return (F.least(F.greatest(value, F.lit(lo)), F.lit(hi)) - lo) / (hi - lo)


def bilinear(k00: Column, k01: Column, k10: Column, k11: Column, fy: Column, fx: Column) -> Column:
    """Bilinear blend of four corners; fractions outside 0..1 extrapolate linearly."""
    return (k00 * (1 - fy) * (1 - fx) + k01 * (1 - fy) * fx + k10 * fy * (1 - fx) + k11 * fy * fx)
