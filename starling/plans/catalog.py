"""The star schema in the session catalog: tables with defaults and required columns, stored views.

Tables are external: their rows lie in the warehouse that the load writes.  A table is created once
(a second call changes nothing); an insert may leave out columns that have a default.  Views are
stored as SQL over the catalog's tables, so that any session of the same catalog can query them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starling.schemas import STAR

# what an insert that leaves a column out gets
DEFAULTS = {
    "dim_agent": {"is_active": "TRUE"},
    "fact_claims": {"approved_amount": "0", "created_at": "CURRENT_TIMESTAMP()"},
    "fact_payments": {"is_late": "FALSE", "days_late": "0", "created_at": "CURRENT_TIMESTAMP()"},
}
# columns that no row may lack: the tables' keys
REQUIRED = {
    "dim_date": ["date_key"], "dim_policy_type": ["policy_type_id", "policy_type"], "dim_county": ["county_id", "county_name"],
    "dim_claim_status": ["status_id", "status_name"], "dim_customer": ["customer_id"], "dim_agent": ["agent_id"],
    "fact_sales": ["sale_id"], "fact_claims": ["claim_id"], "fact_payments": ["payment_id"],
}
MONTH = "date_month"
FACTS = ("fact_sales", "fact_claims", "fact_payments")

VIEWS = {
    "v_premium_by_policy_type": """
        SELECT t.policy_type, COUNT(*) AS policies,
               CAST(ROUND(SUM(s.premium_amount) / NULLIF(CAST(COUNT(s.premium_amount) AS DECIMAL(20,0)), 0), 2) AS DOUBLE) AS avg_premium,
               CAST(ROUND(SUM(s.premium_amount), 2) AS DOUBLE) AS total_premium
        FROM {db}.fact_sales s JOIN {db}.dim_policy_type t USING (policy_type_id) GROUP BY t.policy_type""",
    "v_claims_summary": """
        SELECT st.status_name, COUNT(*) AS claims, CAST(ROUND(SUM(c.claim_amount), 2) AS DOUBLE) AS total_claimed,
               CAST(ROUND(SUM(c.approved_amount), 2) AS DOUBLE) AS total_approved,
               CAST(ROUND(SUM(c.approved_amount / NULLIF(c.claim_amount, CAST(0 AS DECIMAL(12,2))))
                          / NULLIF(CAST(COUNT(c.approved_amount / NULLIF(c.claim_amount, CAST(0 AS DECIMAL(12,2))))
                                        AS DECIMAL(20,0)), 0) * CAST(100 AS DECIMAL(3,0)), 1) AS DOUBLE) AS approval_pct
        FROM {db}.fact_claims c JOIN {db}.dim_claim_status st ON c.status_id = st.status_id GROUP BY st.status_name""",
    "v_payment_methods": """
        SELECT payment_method, COUNT(*) AS transactions, CAST(ROUND(SUM(payment_amount), 2) AS DOUBLE) AS total_collected,
               CAST(ROUND(SUM(payment_amount) / NULLIF(CAST(COUNT(payment_amount) AS DECIMAL(20,0)), 0), 2) AS DOUBLE) AS avg_payment
        FROM {db}.fact_payments GROUP BY payment_method""",
    "v_late_payments": """
        SELECT t.policy_type, COUNT_IF(p.is_late) AS late_payments, COUNT_IF(NOT p.is_late) AS on_time_payments,
               CAST(ROUND(CAST(SUM(p.days_late) AS DECIMAL(20,0)) / NULLIF(CAST(COUNT(p.days_late) AS DECIMAL(20,0)), 0), 1) AS DOUBLE)
                 AS avg_days_late
        FROM {db}.fact_payments p JOIN {db}.dim_policy_type t ON p.policy_type_id = t.policy_type_id GROUP BY t.policy_type""",
    "v_monthly_trends": """
        SELECT TRUNC(date_key, 'MM') AS month, COUNT(DISTINCT sale_id) AS policies_sold,
               CAST(ROUND(SUM(premium_amount), 2) AS DOUBLE) AS premium_volume
        FROM {db}.fact_sales GROUP BY TRUNC(date_key, 'MM')""",
    "v_summary_stats": """
        SELECT STACK(1, 'Total Customers', CAST(COUNT(*) AS STRING)) AS (metric, value) FROM {db}.dim_customer
        UNION ALL SELECT STACK(2, 'Total Policies', CAST(COUNT(*) AS STRING),
                               'Total Premium', CAST(ROUND(SUM(premium_amount), 0) AS STRING)) FROM {db}.fact_sales
        UNION ALL SELECT STACK(2, 'Total Claims', CAST(COUNT(*) AS STRING),
                               'Total Claimed', CAST(ROUND(SUM(claim_amount), 0) AS STRING)) FROM {db}.fact_claims
        UNION ALL SELECT STACK(2, 'Total Payments', CAST(COUNT(*) AS STRING),
                               'Total Collected', CAST(ROUND(SUM(payment_amount), 0) AS STRING)) FROM {db}.fact_payments""",
}


def columns_ddl(schema: T.StructType, defaults: dict[str, str], required: list[str]) -> str:
    parts = []
    for f in schema.fields:
        one = f"`{f.name}` {f.dataType.simpleString()}"
        if f.name in required:
            one += " NOT NULL"
        if f.name in defaults:
            one += f" DEFAULT {defaults[f.name]}"
        parts.append(one)
    return ", ".join(parts)


def create_tables(spark: SparkSession, database: str, root: str) -> list[str]:
    """CREATE TABLE IF NOT EXISTS for every table of the star, over the warehouse's folders."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{root.rstrip('/')}/_catalog'")
    for name, schema in STAR.items():
        partition = ""
        if name in FACTS:
            schema = T.StructType([*schema.fields, T.StructField(MONTH, T.DateType())])
            partition = f"PARTITIONED BY ({MONTH})"
        ddl = columns_ddl(schema, DEFAULTS.get(name, {}), REQUIRED[name])
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` ({ddl}) USING parquet {partition} "
                  f"LOCATION '{root.rstrip('/')}/{name}'")
        if partition:
            # folders that the load has written
            spark.sql(f"ALTER TABLE `{database}`.`{name}` RECOVER PARTITIONS")
        spark.catalog.refreshTable(f"{database}.{name}")
    return list(STAR)


def insert(spark: SparkSession, database: str, name: str, df: DataFrame) -> None:
    """Append rows by column name; columns that are left out get their default, else null.

    A null in a required column fails the insert.
    """
    unknown = [c for c in df.columns if c not in STAR[name].names]
    absent = [c for c in REQUIRED[name] if c not in df.columns]
    if unknown or absent:
        raise ValueError(f"{name}: unknown columns {unknown}, required columns left out {absent}")
    rows = df.withColumns({c: F.when(F.col(c).isNull(), F.raise_error(F.lit(f"{name}.{c} is null"))).otherwise(F.col(c))
                           for c in REQUIRED[name]})
    if name in FACTS:
        day = F.col("date_key") if "date_key" in df.columns else F.lit(None).cast("date")
        rows = rows.withColumn(MONTH, F.trunc(day, "MM"))
    view = f"_insert_{uuid.uuid4().hex}"
    rows.createOrReplaceTempView(view)
    try:
        names = ", ".join(f"`{c}`" for c in rows.columns)
        spark.sql(f"INSERT INTO `{database}`.`{name}` ({names}) SELECT {names} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def create_views(spark: SparkSession, database: str, names: list[str] | None = None) -> list[str]:
    """CREATE OR REPLACE VIEW for the reporting views."""
    names = list(VIEWS) if names is None else names
    for name in names:
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` AS {VIEWS[name].format(db=f'`{database}`')}")
    return names


def drop_view(spark: SparkSession, database: str, name: str) -> None:
    spark.sql(f"DROP VIEW IF EXISTS `{database}`.`{name}`")


def publish(spark: SparkSession, database: str, root: str) -> dict[str, list[str]]:
    """A loaded warehouse as tables and views of the session's catalog."""
    return {"tables": create_tables(spark, database, root), "views": create_views(spark, database)}
