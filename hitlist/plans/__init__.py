"""Pipelines that compose the stages, and the catalog of registered queries."""
