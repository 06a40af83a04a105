"""Wiring of operators into the KPI model, the query registry and the SQL oracle."""
