"""Manifests, audio clips and the tables of earlier runs as DataFrames."""
