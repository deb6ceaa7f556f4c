"""Operators on DataFrames: labelling, mining, sampling, reports, text model."""
