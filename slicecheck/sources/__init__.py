"""Readers for KPI tables, old stores and task lists."""
