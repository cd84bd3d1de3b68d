"""Wire the layer builders together lazily (no action, no write).

``Layers`` builds a table only when it is first asked for, and memoises it,
so a report that needs one gold table does not construct the others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame

from tallyrisk.plans import gold, silver

BUILDERS: dict[str, Callable[["Layers"], DataFrame]] = {
    "silver_accounts": lambda L: silver.silver_accounts(
        L["bronze_accounts"], L["bronze_transactions"], L.as_of),
    "silver_customers": lambda L: silver.silver_customers(
        L["bronze_customers"], L["bronze_interactions"], L["bronze_fraud_reports"],
        L["bronze_accounts"], L.as_of),
    # Enrichment reads only age/risk score and balance: built from the same
    # expressions as the silver tables without constructing their whole plans.
    "silver_transactions": lambda L: silver.silver_transactions(
        L["bronze_transactions"], L["customer_basics"], L["account_basics"], L.as_of),
    "transaction_basics": lambda L: L["silver_transactions"] if L.given("silver_transactions")
    else silver.transaction_basics(L["bronze_transactions"]),
    "customer_basics": lambda L: silver.customer_basics(L["bronze_customers"], L.as_of),
    "account_basics": lambda L: silver.account_basics(L["bronze_accounts"], L.as_of),
    "gold_customer_360": lambda L: gold.customer_360(
        L["silver_customers"], L["transaction_basics"], L.as_of),
    "gold_fraud_features": lambda L: gold.fraud_features(
        L["silver_transactions"], L["account_basics"], L.as_of, bucket_hours=L.bucket_hours,
        basics=L["transaction_basics"]),
    "gold_daily_fraud_summary": lambda L: gold.daily_fraud_summary(L["transaction_basics"], L.as_of),
}


class Layers(Mapping):
    """Read-only mapping table name -> DataFrame, built on first access.

    ``sources`` maps names to DataFrames or to zero-argument callables
    returning one (e.g. bronze tables read from storage, or stored silver
    tables, which then take precedence over the builders).
    """

    def __init__(self, sources: Mapping[str, object], as_of, bucket_hours: int = 24):
        self._sources = dict(sources)
        self._cache: dict[str, DataFrame] = {}
        self.as_of = as_of
        self.bucket_hours = bucket_hours

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            if name in self._sources:
                src = self._sources[name]
                self._cache[name] = src() if callable(src) else src
            elif name in BUILDERS:
                self._cache[name] = BUILDERS[name](self)
            else:
                raise KeyError(name)
        return self._cache[name]

    def given(self, name: str) -> bool:
        """Whether the table is read rather than built."""
        return name in self._sources

    def features(self, *columns: str) -> DataFrame:
        """gold_fraud_features with these columns only; a lazy one is built without the steps they don't need."""
        if self.given("gold_fraud_features"):
            return self["gold_fraud_features"].select(*columns)
        return gold.fraud_features(self["silver_transactions"], self["account_basics"], self.as_of,
                                   bucket_hours=self.bucket_hours, basics=self["transaction_basics"], columns=list(columns))

    def lean(self) -> "Layers":
        """The same tables for checks of keys and counts: the large lazy ones with their key columns only."""
        sources = {n: (lambda n=n: self[n]) for n in self}
        if not self.given("gold_fraud_features"):
            sources["gold_fraud_features"] = lambda: self.features("transaction_id", "customer_id", "account_id")
        sources["silver_transactions"] = lambda: self["transaction_basics"]
        return Layers(sources, self.as_of, self.bucket_hours)

    def __iter__(self) -> Iterator[str]:
        return iter(dict.fromkeys([*self._sources, *BUILDERS]))

    def __len__(self) -> int:
        return len(set(self._sources) | set(BUILDERS))


def all_layers(bronze: Mapping[str, object], as_of, bucket_hours: int = 24) -> Layers:
    return Layers(bronze, as_of, bucket_hours)
