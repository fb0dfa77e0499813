"""Compositions of operators: facts, the health mart, metric layer, reports, pipeline."""
