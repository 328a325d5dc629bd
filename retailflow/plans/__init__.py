"""Jobs: Silver, Gold, data quality, end-to-end runner, registered queries and oracle SQL."""
