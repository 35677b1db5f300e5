"""Runs that load, stage, aggregate and check stored tables."""
