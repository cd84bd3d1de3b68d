"""Layered transaction-risk analytics on Spark.

Raw entity files are loaded into a bronze layer, cleaned and enriched into
silver tables, and summarised into gold tables (customer profile, per
transaction risk features, daily fraud summary) plus reports and data
quality checks.  Every transform is a lazy function of DataFrames and an
explicit ``as_of`` instant, so a run is reproducible.

Main entry points::

    from tallyrisk import build_session, silver, gold, reports, runs
    spark = build_session()
    feats = gold.fraud_features(silver_transactions, silver_accounts, as_of="2024-02-03 12:00:00")
"""

from tallyrisk.plans import gold, reports, runs, silver, verify
from tallyrisk.operators import quality, velocity
from tallyrisk.session import build_session, shared_dir, sizing_conf

__all__ = ["build_session", "shared_dir", "sizing_conf", "silver", "gold", "reports", "runs",
           "verify", "quality", "velocity"]
