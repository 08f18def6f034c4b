"""Inputs and tables on files."""
