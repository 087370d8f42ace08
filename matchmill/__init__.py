"""Match-statistics warehouse as Spark plans: landed JSON to facts, marts and dashboards."""
