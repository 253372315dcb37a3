"""aloft: flight-disruption analytics on Spark (DataFrame/SQL + Spark ML)."""
