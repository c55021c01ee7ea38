"""Tabular analytics and modelling operators expressed as Spark jobs."""
