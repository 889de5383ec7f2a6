"""Order-operations analytics on Spark: intake, rules, snapshot, rollups, dashboards."""
