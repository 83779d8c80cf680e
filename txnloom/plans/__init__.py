"""Composed work: reports, measures, catalog objects, exports and jobs."""
