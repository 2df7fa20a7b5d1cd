"""The retail warehouse: silver models, gold star, KPI queries, declared checks."""
