"""Composite jobs, the demo tag catalog and the registered queries."""
