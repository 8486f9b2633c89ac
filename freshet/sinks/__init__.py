"""Targets, partitioned outputs and exports."""
