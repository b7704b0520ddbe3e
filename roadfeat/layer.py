"""A DataFrame of geometries together with its coordinate system."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

from roadfeat.config import PROJECT_CRS
from roadfeat.functions import crs as crs_fn

POINT, LINE, POLYGON = "point", "line", "polygon"


@dataclass(frozen=True)
class Layer:
    """Points keep ``x, y``; lines and polygons keep ``parts`` (lines or rings).

    ``parts`` is ``array<array<struct<x: double, y: double>>>``. The coordinate
    system (an EPSG code, a projection or a datum) belongs to the whole layer, so it is no column. ``size_bound`` may name
    a frame that has at least as many rows as ``df``, for the join's size check.
    ``stored`` says that ``df`` is read from storage, so reading it again is cheap.
    """

    df: DataFrame
    kind: str = POINT
    crs: crs_fn.Crs | None = PROJECT_CRS
    size_bound: DataFrame | None = None
    stored: bool = False

    def to_crs(self, target: crs_fn.Crs) -> "Layer":
        if self.crs is None or self.crs == target:
            return replace(self, crs=target)
        if self.kind == POINT:
            df = crs_fn.project_points(self.df, "x", "y", self.crs, target)
        else:
            # Boxes that a source gave are in its own system.
            df = self.df.drop("xmin", "ymin", "xmax", "ymax")
            df = df.withColumn("parts", crs_fn.project_parts("parts", self.crs, target))
        return replace(self, df=df, crs=target, stored=False)

    def drop_empty(self) -> "Layer":
        """Keep the rows that have a geometry."""
        if self.kind == POINT:
            return replace(self, df=self.df.dropna(subset=["x", "y"]))
        from roadfeat.functions.geometry import has_vertices

        return replace(self, df=self.df.where(has_vertices("parts")))
