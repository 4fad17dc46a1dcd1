"""Composite plans: series features, participant features, model table, profiles, modelling."""
