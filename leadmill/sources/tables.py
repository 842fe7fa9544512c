"""Named access to the pipeline tables for one data folder."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from . import fixtures as fx


class Tables:
    """The reference's tables, as DataFrames derived from the parquet tables in ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return fx._t(self.spark, self.sf_dir, name)

    @cached_property
    def drive_metadata(self) -> DataFrame:
        return fx.drive_metadata(self.spark, self.sf_dir)

    @cached_property
    def leads(self) -> DataFrame:
        return fx.leads(self.spark, self.sf_dir)

    @cached_property
    def customers(self) -> DataFrame:
        return fx.sales_customer_view(self.spark, self.sf_dir)

    @cached_property
    def tracking(self) -> DataFrame:
        return fx.tracking(self.spark, self.sf_dir)

    @cached_property
    def city_search(self) -> DataFrame:
        return fx.city_search(self.spark, self.sf_dir)

    @cached_property
    def city_search_nulls(self) -> DataFrame:
        return fx.city_search(self.spark, self.sf_dir, with_null_dataids=True)

    @cached_property
    def franchises(self) -> DataFrame:
        return fx.city_search_franchises(self.spark, self.sf_dir)

    @cached_property
    def franchise_list(self) -> DataFrame:
        return fx.franchise_list(self.spark, self.sf_dir)

    @cached_property
    def enriched(self) -> DataFrame:
        return fx.city_search_enriched(self.spark, self.sf_dir)

    @cached_property
    def new_listing(self) -> DataFrame:
        return fx.new_listing(self.spark, self.sf_dir)

    @cached_property
    def config_sheet(self) -> DataFrame:
        return fx.config_sheet(self.spark, self.sf_dir)

    @cached_property
    def folder_names(self) -> DataFrame:
        return fx.folder_names(self.spark, self.sf_dir)

    @cached_property
    def nodes(self) -> DataFrame:
        return fx.nodes(self.spark, self.sf_dir)

    @cached_property
    def listing_records(self) -> DataFrame:
        return fx.listing_records(self.spark, self.sf_dir)
