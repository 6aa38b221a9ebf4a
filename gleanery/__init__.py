"""Consolidation of observation records from many publishers, as Spark jobs."""
