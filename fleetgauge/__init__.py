"""fleetgauge: KPIs over an asset inventory, computed and historised with Spark."""
