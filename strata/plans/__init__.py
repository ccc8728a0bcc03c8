"""Composed data products: silver, gold, warehouse, dashboard queries, extras, lake build."""
