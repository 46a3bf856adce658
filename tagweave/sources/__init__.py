"""Inputs and table storage: catalog, warehouse tables, text, JDBC."""
