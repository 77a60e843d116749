"""A lazily built star schema over a mapping of domain tables.

``Star(spark, domain, params)`` exposes every dimension and fact as a cached
attribute (the DataFrame object is reused, so each plan is defined once).
``Star.from_tables`` wraps an already materialised star schema (e.g. read
back from the warehouse) so analytics run on stored tables.
"""

from __future__ import annotations

import dataclasses
from functools import cached_property

from pyspark.sql import DataFrame, Observation, SparkSession

from starling.params import RunParams
from starling.plans import dims, facts
from starling.sources import testbed


class Star:
    def __init__(self, spark: SparkSession, domain: dict[str, DataFrame], params: RunParams,
                 tables: dict[str, DataFrame] | None = None):
        self.spark = spark
        self.domain = domain
        self.params = params
        self._given = dict(tables or {})
        # counts to gather while a table is written, by table name
        self.observations: dict[str, Observation] = {}

    @classmethod
    def from_sf_dir(cls, spark: SparkSession, sf_dir: str, params: RunParams | None = None) -> "Star":
        params = params or RunParams()
        return cls(spark, testbed.domain(spark, sf_dir, params), params)

    @classmethod
    def from_tables(cls, spark: SparkSession, tables: dict[str, DataFrame], params: RunParams,
                    domain: dict[str, DataFrame] | None = None, stored: bool = False) -> "Star":
        """Wrap given tables; ``stored=True`` (read from files) lets the planner's
        file-size statistics decide broadcasts instead of a row-count probe."""
        if stored:
            params = dataclasses.replace(params, broadcast_max_rows=None)
        return cls(spark, domain or {}, params, tables)

    def _get(self, name, build):
        return self._given[name] if name in self._given else build()

    # ---- domain ----
    @property
    def customers(self) -> DataFrame:
        return self.domain["customers"]

    @property
    def policies(self) -> DataFrame:
        return self.domain["policies"]

    @property
    def claims(self) -> DataFrame:
        return self.domain["claims"]

    @property
    def agents(self) -> DataFrame:
        return self.domain["agents"]

    @property
    def region_map(self) -> DataFrame | None:
        return self.domain.get("region_map")

    # ---- dimensions ----
    @cached_property
    def dim_date(self) -> DataFrame:
        return self._get("dim_date", lambda: dims.dim_date(self.spark, self.domain.get("policies"), self.params))

    @cached_property
    def dim_policy_type(self) -> DataFrame:
        return self._get("dim_policy_type", lambda: dims.dim_policy_type(self.policies))

    @cached_property
    def dim_county(self) -> DataFrame:
        return self._get("dim_county", lambda: dims.dim_county(self.customers))

    @cached_property
    def dim_claim_status(self) -> DataFrame:
        return self._get("dim_claim_status", lambda: dims.dim_claim_status(self.spark))

    @cached_property
    def dim_customer(self) -> DataFrame:
        return self._get("dim_customer", lambda: dims.dim_customer(self.customers, self.params, self.region_map))

    @cached_property
    def dim_agent(self) -> DataFrame:
        return self._get("dim_agent", lambda: dims.dim_agent(self.agents, self.region_map))

    # ---- facts ----
    @cached_property
    def fact_sales(self) -> DataFrame:
        return self._get("fact_sales", lambda: facts.fact_sales(
            self.policies, self.dim_customer, self.dim_policy_type, self.dim_county, self.dim_agent, self.params))

    @cached_property
    def fact_claims(self) -> DataFrame:
        return self._get("fact_claims", lambda: facts.fact_claims(
            self.claims, self.dim_customer, self.dim_county, self.policies, self.dim_policy_type,
            self.dim_claim_status, self.params))

    @cached_property
    def fact_payments(self) -> DataFrame:
        return self._get("fact_payments", lambda: facts.fact_payments(
            self.policies, self.dim_customer, self.dim_county, self.dim_policy_type, self.dim_date, self.params,
            self.observations.get("fact_payments")))

    @cached_property
    def payment_rows(self) -> DataFrame:
        """Installments before the calendar check."""
        return facts.payment_rows(self.policies, self.dim_customer, self.dim_county, self.dim_policy_type, self.params)

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)
