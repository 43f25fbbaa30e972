"""The whole preparation as one fitted object, used alike for training, scoring and streams."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tabflow.operators import binning, encoding, missing, outliers, scaling
from tabflow.sources.shared import persist_state


@dataclass(frozen=True)
class Roles:
    """Which column plays which part."""

    key: str
    target: str
    numeric: list[str]
    nominal: list[str] = field(default_factory=list)
    capped: list[str] = field(default_factory=list)
    bins: dict[str, dict[str, list[float]]] = field(default_factory=dict)
    ordinal: dict[str, dict[str, int]] = field(default_factory=dict)
    drop: list[str] = field(default_factory=list)


@dataclass(frozen=True)
class Preparation:
    """Fitted state; every part is a small written table."""

    roles: Roles
    fill: DataFrame
    bounds: DataFrame | None
    codes: DataFrame | None
    scale: DataFrame

    def apply(self, df: DataFrame) -> DataFrame:
        """Fill, cap, bin, encode and scale a table or a stream by the fitted state."""
        out = _clean(df, self.roles, self.fill, self.bounds)
        for column, bins in self.roles.bins.items():
            out = binning.bin_custom(out, column, bins, keep=column in self.roles.numeric)
        out = encoding.encode_ordinal(out, self.roles.ordinal)
        if self.codes is not None:
            out = encoding.apply_index(out, self.codes, self.roles.nominal)
        return scaling.scale_minmax(out, self.scale).drop(*self.roles.drop)

    def save(self, root: str) -> None:
        for name in ("fill", "bounds", "codes", "scale"):
            part = getattr(self, name)
            if part is not None:
                part.write.mode("overwrite").parquet(f"{root}/{name}")


def _clean(df: DataFrame, roles: Roles, fill: DataFrame, bounds: DataFrame | None) -> DataFrame:
    out = missing.apply_fill(df, fill)
    return outliers.cap(out, bounds) if bounds is not None else out


def fit(train: DataFrame, roles: Roles, exact: bool = False) -> Preparation:
    """Fit every step on the training rows only, each on the output of the steps before it."""
    fill = persist_state(missing.fit_fill(train, roles.numeric, "mean"), "fill")
    bounds = None
    if roles.capped:
        filled = missing.apply_fill(train, fill)
        bounds = persist_state(outliers.fit_iqr(filled, roles.capped, exact=exact), "bounds")
    codes = encoding.fit_index(train, roles.nominal) if roles.nominal else None
    cleaned = _clean(train, roles, fill, bounds)
    scale = persist_state(scaling.fit_moments(cleaned, roles.numeric), "scale")
    return Preparation(roles, fill, bounds, codes, scale)


def restore(spark: SparkSession, roles: Roles, root: str) -> Preparation:
    read = lambda name: spark.read.parquet(f"{root}/{name}")
    return Preparation(
        roles,
        read("fill"),
        read("bounds") if roles.capped else None,
        read("codes") if roles.nominal else None,
        read("scale"),
    )
