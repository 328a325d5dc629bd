"""Inputs and outputs: driver-table scans and fixtures, generators, catalog loads."""
