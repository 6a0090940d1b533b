"""Operators by subject: base views, quality, sales, mix, cohorts, stock gaps, time series,
experiments, star marts, KPIs and incremental loads."""
