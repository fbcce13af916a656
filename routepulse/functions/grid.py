"""Hexagonal cells.

``PlanarGrid`` is column arithmetic only, so it stays inside
whole-stage codegen: coordinates are projected onto a flat plane around a city,
turned into axial hexagon coordinates and rounded to the nearest hexagon. Inside a
job a cell is two integers; its text id is made once per aggregated row.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routepulse.schemas import CITY_CENTER, HEX_RESOLUTION, KM_PER_DEGREE

# Hexagon edge at resolution 8 (about 0.74 km2 per cell); each finer resolution
# has a seventh of the area.
EDGE_KM_AT_8 = 0.5327


def _nearest(value: Column) -> Column:
    return F.floor(value + 0.5)


@dataclass(frozen=True)
class PlanarGrid:
    res: int = HEX_RESOLUTION
    center: tuple[float, float] = CITY_CENTER

    keys = ("cell_q", "cell_r")

    @property
    def edge_km(self) -> float:
        return EDGE_KM_AT_8 * math.sqrt(7.0) ** (8 - self.res)

    @property
    def km_per_degree_lon(self) -> float:
        return KM_PER_DEGREE * math.cos(math.radians(self.center[0]))

    def locate(self, df: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
        """Add the cell's two integer coordinates; unusable input gives NULL.

        Each step is a column of its own that later ones refer to, so it is computed
        once per row instead of being copied into one huge expression.
        """
        usable = (F.abs(F.col(lat)) <= 90) & (F.abs(F.col(lon)) <= 360)
        steps = df.withColumns(
            {
                "_x": (F.when(usable, F.col(lon)) - self.center[1]) * self.km_per_degree_lon,
                "_y": (F.when(usable, F.col(lat)) - self.center[0]) * KM_PER_DEGREE,
            }
        ).withColumns(
            {
                "_q": (math.sqrt(3) / 3 * F.col("_x") - F.col("_y") / 3) / self.edge_km,
                "_r": (2 / 3 * F.col("_y")) / self.edge_km,
            }
        )
        steps = steps.withColumn("_s", -F.col("_q") - F.col("_r"))
        # Round all three cube coordinates, then rebuild the one that moved most.
        steps = steps.withColumns({f"_r{c}": _nearest(F.col(f"_{c}")) for c in "qrs"})
        steps = steps.withColumns({f"_d{c}": F.abs(F.col(f"_r{c}") - F.col(f"_{c}")) for c in "qrs"})
        rq, rr, rs = (F.col(f"_r{c}") for c in "qrs")
        q_worst = (F.col("_dq") > F.col("_dr")) & (F.col("_dq") > F.col("_ds"))
        r_worst = ~q_worst & (F.col("_dr") > F.col("_ds"))
        return steps.select(
            *df.columns,
            F.when(q_worst, -rr - rs).otherwise(rq).cast("int").alias("cell_q"),
            F.when(r_worst, -rq - rs).otherwise(rr).cast("int").alias("cell_r"),
        )

    def _center_of(self, q: Column, r: Column) -> tuple[Column, Column]:
        x = self.edge_km * math.sqrt(3) * (q + r / 2)
        y = self.edge_km * 1.5 * r
        return (
            self.center[0] + y / KM_PER_DEGREE,
            self.center[1] + x / self.km_per_degree_lon,
        )

    def cell_id(self) -> Column:
        q, r = F.col("cell_q"), F.col("cell_r")
        text = F.concat_ws(":", F.lit(str(self.res)), q.cast("string"), r.cast("string"))
        return F.when(q.isNotNull() & r.isNotNull(), text)

    def name_cells(self, df: DataFrame, out: str = "h3") -> DataFrame:
        """Replace the integer coordinates by the id and the centre."""
        lat, lon = self._center_of(F.col("cell_q"), F.col("cell_r"))
        return df.withColumns({out: self.cell_id(), "hex_lat": lat, "hex_lon": lon}).drop(
            *self.keys
        )

    def centers(self, df: DataFrame, cell: str = "h3") -> DataFrame:
        """Add the centre of a text cell id."""
        parts = F.split(F.col(cell), ":")
        lat, lon = self._center_of(
            F.get(parts, F.lit(1)).cast("int"), F.get(parts, F.lit(2)).cast("int")
        )
        return df.withColumns({"hex_lat": lat, "hex_lon": lon})


def add_cells(
    df: DataFrame,
    res: int = HEX_RESOLUTION,
    lat: str = "lat",
    lon: str = "lon",
    grid: PlanarGrid | None = None,
    out: str = "h3",
) -> DataFrame:
    """Tag every row with its cell id."""
    grid = grid or PlanarGrid(res)
    located = grid.locate(df, lat, lon)
    return located.withColumn(out, grid.cell_id()).drop(*grid.keys)


def add_cell_centers(
    df: DataFrame, cell: str = "h3", grid: PlanarGrid | None = None
) -> DataFrame:
    """Add hex_lat / hex_lon of the cell id; call it on aggregated rows."""
    return (grid or PlanarGrid()).centers(df, cell)
