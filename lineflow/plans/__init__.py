"""Declarations: how a DataFrame's columns make rows, and small queries over tables."""
