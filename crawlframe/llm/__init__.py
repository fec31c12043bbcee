"""Operators for preparing training text: one module for each operator."""
