"""Inputs: wire streams, reference tables, JSON exports."""
