"""Lazily assembled inputs shared by the jobs: enriched facts, product
metadata, encodings and product features, from raw facts and dimensions."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from ..operators import clean


@dataclass
class Prepared:
    sales: DataFrame
    products: DataFrame
    towns: DataFrame

    @cached_property
    def meta(self) -> DataFrame:
        return clean.product_metadata(self.products)

    @cached_property
    def brand_map(self) -> DataFrame:
        return clean.brand_map(self.meta)

    @cached_property
    def brand_encoding(self) -> DataFrame:
        return clean.brand_encoding(self.meta)

    @cached_property
    def state_map(self) -> DataFrame:
        return clean.state_encoding(self.sales, self.towns)

    @cached_property
    def processed(self) -> DataFrame:
        return clean.preprocess(self.sales, self.meta, self.towns, self.state_map)

    @cached_property
    def product_features(self) -> DataFrame:
        return clean.product_features(self.meta, self.brand_encoding)

    def feature_kwargs(self) -> dict:
        return dict(product_feats=self.product_features, brand_map=self.brand_map,
                    towns=self.towns, state_map=self.state_map)
