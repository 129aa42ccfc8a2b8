"""Whole questions and jobs, put together from the operators."""
