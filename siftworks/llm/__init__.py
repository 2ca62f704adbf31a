"""Operators of a training-data pipeline over the table `documents` and its kin."""
