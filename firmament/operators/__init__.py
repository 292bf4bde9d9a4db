"""Reusable table operators the jobs are made of."""
