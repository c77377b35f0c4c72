"""Projection onto the world-ocean square. Needs the `pyproj` package, which is optional."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

# Fixed value: half the square's width in metres.
HALF = 11_802_700.0


def square(cells: DataFrame, definition: str = "+proj=spilhaus", half: float = HALF) -> DataFrame:
    """cell, lon, lat to cell, u, v in 0..1; points that the projection cannot place are dropped."""
    try:
        import pyproj  # noqa: F401
    except ImportError as missing:
        raise RuntimeError("the square projection needs pyproj") from missing

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyproj import Transformer

        move = Transformer.from_crs("EPSG:4326", definition, always_xy=True)
        for part in parts:
            x, y = move.transform(part["lon"].to_numpy(), part["lat"].to_numpy())
            out = pd.DataFrame({"cell": part["cell"], "u": ((x + half) / (2 * half)).round(5), "v": ((half - y) / (2 * half)).round(5)})
            yield out[out["u"].between(-10, 10) & out["v"].between(-10, 10)]

    return cells.select("cell", "lon", "lat").mapInPandas(run, "cell long, u double, v double")
