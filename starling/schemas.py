"""Explicit schemas for the domain (OLTP) tables, the star schema and the event log.

Money is DECIMAL(12,2) (the batch money DDL), event amounts DECIMAL(15,2),
ids are strings from the scan on so joins never need casts.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
EVENT_MONEY = T.DecimalType(15, 2)
RATE = T.DecimalType(5, 4)


def _s(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


S, I, D, TS, B = T.StringType(), T.IntegerType(), T.DateType(), T.TimestampType(), T.BooleanType()

CUSTOMERS = _s(("customer_id", S), ("full_name", S), ("age", I), ("gender", S), ("county", S),
               ("signup_date", D), ("ingested_at", TS))
POLICIES = _s(("policy_id", S), ("customer_id", S), ("policy_type", S), ("premium", MONEY),
              ("start_date", D), ("end_date", D), ("status", S))
CLAIMS = _s(("claim_id", S), ("policy_id", S), ("customer_id", S), ("claim_type", S),
            ("claim_amount", MONEY), ("claim_status", S), ("incident_date", D), ("claim_date", D),
            ("approved_amount", MONEY), ("created_at", TS))
AGENTS = _s(("agent_id", S), ("full_name", S), ("phone", S), ("email", S), ("county", S),
            ("hire_date", D), ("status", S))
SALES = _s(("sale_id", S), ("policy_id", S), ("customer_id", S), ("agent_id", S), ("sale_date", D),
           ("commission_rate", RATE), ("commission_amount", MONEY), ("premium_amount", MONEY))
PAYMENTS = _s(("payment_id", S), ("policy_id", S), ("customer_id", S), ("payment_date", D),
              ("amount", MONEY), ("payment_method", S), ("status", S))
REGION_MAP = _s(("county", S), ("region", S))

DIM_DATE = _s(("date_key", D), ("day", I), ("month", I), ("month_name", S), ("quarter", I),
              ("quarter_name", S), ("year", I), ("day_of_week", I), ("day_name", S),
              ("is_weekend", B), ("is_month_start", B), ("is_month_end", B), ("week_of_year", I))
DIM_POLICY_TYPE = _s(("policy_type_id", I), ("policy_type", S))
DIM_COUNTY = _s(("county_id", I), ("county_name", S))
DIM_CLAIM_STATUS = _s(("status_id", I), ("status_name", S))
DIM_CUSTOMER = _s(("customer_id", S), ("full_name", S), ("age", I), ("age_band", S), ("gender", S),
                  ("county", S), ("region", S), ("signup_date", D), ("customer_tenure", S),
                  ("ingested_at", TS))
DIM_AGENT = _s(("agent_id", S), ("agent_name", S), ("agent_code", S), ("region", S), ("channel", S),
               ("hire_date", D), ("is_active", B))

FACT_SALES = _s(("sale_id", S), ("policy_id", S), ("customer_id", S), ("agent_id", S), ("date_key", D),
                ("policy_type_id", I), ("county_id", I), ("premium_amount", MONEY),
                ("commission_rate", RATE), ("policy_type", S), ("start_date", D), ("end_date", D),
                ("policy_status", S))
FACT_CLAIMS = _s(("claim_id", S), ("policy_id", S), ("customer_id", S), ("date_key", D),
                 ("incident_date_key", D), ("status_id", I), ("county_id", I), ("policy_type_id", I),
                 ("claim_type", S), ("claim_amount", MONEY), ("approved_amount", MONEY),
                 ("claim_status", S), ("incident_date", D), ("claim_date", D), ("created_at", TS))
FACT_PAYMENTS = _s(("payment_id", S), ("policy_id", S), ("customer_id", S), ("date_key", D),
                   ("county_id", I), ("policy_type_id", I), ("payment_amount", MONEY),
                   ("expected_amount", MONEY), ("variance", MONEY), ("is_full_payment", B),
                   ("payment_method", S), ("payment_status", S), ("payment_frequency", S),
                   ("is_late", B), ("days_late", I), ("payment_date", D), ("due_date", D),
                   ("created_at", TS))

# one union schema for every stream message type (from_json)
EVENT_MESSAGE = _s(("event_type", S), ("event_id", S), ("policy_id", S), ("customer_name", S),
                   ("policy_type", S), ("premium_amount", EVENT_MONEY), ("county", S),
                   ("start_date", S), ("claim_id", S), ("claim_amount", EVENT_MONEY), ("status", S),
                   ("incident_date", S), ("payment_id", S), ("amount_paid", EVENT_MONEY),
                   ("payment_method", S), ("payment_date", S), ("timestamp", TS))
EVENT_LOG_STRICT = _s(("event_type", S), ("event_id", S), ("policy_id", S), ("amount", EVENT_MONEY),
                      ("extra_info", S), ("event_timestamp", TS), ("ingested_at", TS))
EVENT_LOG_LENIENT = _s(("event_type", S), ("event_id", S), ("policy_id", S), ("customer_name", S),
                       ("amount", EVENT_MONEY), ("extra_info", S), ("event_timestamp", TS),
                       ("ingested_at", TS))

DOMAIN = {"customers": CUSTOMERS, "policies": POLICIES, "claims": CLAIMS, "agents": AGENTS,
          "sales": SALES, "payments": PAYMENTS}
STAR = {"dim_date": DIM_DATE, "dim_policy_type": DIM_POLICY_TYPE, "dim_county": DIM_COUNTY,
        "dim_claim_status": DIM_CLAIM_STATUS, "dim_customer": DIM_CUSTOMER, "dim_agent": DIM_AGENT,
        "fact_sales": FACT_SALES, "fact_claims": FACT_CLAIMS, "fact_payments": FACT_PAYMENTS}


def conform(df, schema: T.StructType):
    """Select ``schema``'s columns in order, cast to the declared types."""
    from pyspark.sql import functions as F
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def assert_schema(df, schema: T.StructType) -> None:
    """Fail fast when a frame does not carry exactly the declared columns/types."""
    got = [(f.name, f.dataType) for f in df.schema.fields]
    want = [(f.name, f.dataType) for f in schema.fields]
    if got != want:
        raise ValueError(f"schema mismatch:\n got  {got}\n want {want}")
