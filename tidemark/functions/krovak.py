"""Projected national grid (S-JTSK / Krovak East North) to WGS84, closed form in numpy behind one Arrow UDF."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bessel ellipsoid, Krovak's cone, and the seven parameters to WGS84 (metres, arc seconds in the
# coordinate-frame convention, parts per million). A shift alone is off by ten metres, the spacing of house numbers.
A, E2 = 6377397.155, 0.006674372230614
PHI0, S0, K0, ALPHA0, LON0 = np.radians(49.5), np.radians(78.5), 0.9999, np.radians(30.2881397527778), np.radians(24.8333333333333)
SHIFT, TURN, SCALE = (572.213, 85.334, 461.94), (-4.9732, -1.529, -5.2484), 3.5378
WGS_A, WGS_E2 = 6378137.0, 0.00669437999014


def to_bessel(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Latitude and longitude on Bessel's ellipsoid, in radians, of positive southing ``x`` and westing ``y``."""
    e = np.sqrt(E2)
    alpha = np.sqrt(1 + E2 * np.cos(PHI0) ** 4 / (1 - E2))
    u0 = np.arcsin(np.sin(PHI0) / alpha)
    g = ((1 + e * np.sin(PHI0)) / (1 - e * np.sin(PHI0))) ** (alpha * e / 2)
    k = np.tan(u0 / 2 + np.pi / 4) / np.tan(PHI0 / 2 + np.pi / 4) ** alpha * g
    n0 = A * np.sqrt(1 - E2) / (1 - E2 * np.sin(PHI0) ** 2)
    n, rho0 = np.sin(S0), K0 * n0 / np.tan(S0)
    rho, eps = np.hypot(x, y), np.arctan2(y, x)
    d = eps / n
    s = 2 * (np.arctan((rho0 / rho) ** (1 / n) * np.tan(S0 / 2 + np.pi / 4)) - np.pi / 4)
    u = np.arcsin(np.cos(ALPHA0) * np.sin(s) - np.sin(ALPHA0) * np.cos(s) * np.cos(d))
    dv = np.arcsin(np.cos(s) * np.sin(d) / np.cos(u))
    lon = LON0 - dv / alpha
    phi = u
    for _ in range(8):
        phi = 2 * (np.arctan(k ** (-1 / alpha) * np.tan(u / 2 + np.pi / 4) ** (1 / alpha) * ((1 + e * np.sin(phi)) / (1 - e * np.sin(phi))) ** (e / 2)) - np.pi / 4)
    return phi, lon


def to_wgs84(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Latitude and longitude in degrees of positive southing ``x`` and westing ``y``."""
    phi, lon = to_bessel(x, y)
    radius = A / np.sqrt(1 - E2 * np.sin(phi) ** 2)
    x0, y0, z0 = radius * np.cos(phi) * np.cos(lon), radius * np.cos(phi) * np.sin(lon), radius * (1 - E2) * np.sin(phi)
    rx, ry, rz = np.radians(np.array(TURN) / 3600)
    m = 1 + SCALE * 1e-6
    px, py, pz = SHIFT[0] + m * (x0 + rz * y0 - ry * z0), SHIFT[1] + m * (y0 - rz * x0 + rx * z0), SHIFT[2] + m * (z0 + ry * x0 - rx * y0)
    flat = np.hypot(px, py)
    lat = np.arctan2(pz, flat * (1 - WGS_E2))
    for _ in range(6):
        lat = np.arctan2(pz + WGS_E2 * WGS_A / np.sqrt(1 - WGS_E2 * np.sin(lat) ** 2) * np.sin(lat), flat)
    return np.degrees(lat), np.degrees(np.arctan2(py, px))


@F.pandas_udf(T.StructType([T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())]))
def krovak_to_wgs84(x: pd.Series, y: pd.Series) -> pd.DataFrame:
    """Signs are ignored: exports write both axes negative or positive."""
    lat, lon = to_wgs84(np.abs(x.to_numpy(float)), np.abs(y.to_numpy(float)))
    return pd.DataFrame({"lat": lat, "lon": lon})
