"""KPI families, the KPI registry and the daily and monthly jobs."""
