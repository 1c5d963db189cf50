"""Whole runs, as plans over tables of files and model responses."""
