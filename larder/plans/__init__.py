"""Query plans: lineage wiring, dashboards, layered run, registry."""
