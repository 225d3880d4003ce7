"""Reusable DataFrame operators: rollups, period comparison, first-seen cohorts, top-k, flattening."""
