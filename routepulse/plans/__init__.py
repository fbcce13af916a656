"""Whole jobs and fleet views composed from the operators."""
