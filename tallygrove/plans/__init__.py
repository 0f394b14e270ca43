"""Composite plans: cleaning run, KPI reports, flat views, dashboard data."""
