"""The driver's tables as domain tables, the registered queries and their SQL."""
