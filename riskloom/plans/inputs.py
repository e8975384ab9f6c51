"""The tables a run starts from, and what configuration makes of them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.features import (
    config_guard,
    feature_flags,
    feature_lists,
    geo_names,
    model_features,
    selected_features,
)
from riskloom.sources.scratch import fix_small


@dataclass(frozen=True)
class Inputs:
    """``store``: snapshots; ``feature_config``: wide flags; ``geo_config``: GEO rows;
    ``exclusions``: guard list; ``rules``: bucket rule per geo; ``date_columns``: dates as text."""

    store: DataFrame
    feature_config: DataFrame
    geo_config: DataFrame
    exclusions: DataFrame
    rules: DataFrame
    date_columns: list[str]

    def features(self) -> DataFrame:
        return model_features(self.store, self.date_columns)

    def selected(self) -> DataFrame:
        """(geo, feature) pairs of all geos; of configuration size."""
        flags = feature_flags(self.feature_config, geo_names(self.geo_config))
        return fix_small(selected_features(flags, self.features(), self.exclusions))

    def active_rules(self) -> DataFrame:
        """Bucket rules of the configured geos."""
        names = self.geo_config.select(F.col("GEO").alias("geo"))
        return self.rules.join(names, "geo", "left_semi")

    def checked_lists(self, selected: DataFrame | None = None) -> dict[str, list[str]]:
        """Feature lists of all geos; raises ConfigError if any geo is not usable."""
        selected = self.selected() if selected is None else selected
        config_guard(self.geo_config, selected, self.rules)
        return feature_lists(selected)
