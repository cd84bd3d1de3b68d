"""Layer plans: bronze load, silver cleaning, gold features, reports, runs."""
