"""Registered queries over the driver's tables, with their DuckDB SQL."""
