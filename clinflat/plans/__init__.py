"""Declared tables and models built from the operators."""
