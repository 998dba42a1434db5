"""Composed analyses: panel build, regressions, reports, and the registry of
named queries over the driver tables (:mod:`panelforge.plans.catalog`)."""
