"""Composed jobs: the KPI document of a run and its supervision over time."""
