"""Composite jobs: the pipeline, the profiles and the readiness roll-up."""
