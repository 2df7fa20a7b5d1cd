"""Declarative data-quality rules, the fused runner and the metrics log."""
