"""Typed tables, business tables, reports and health checks of a retail warehouse."""
