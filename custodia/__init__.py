"""Platform governance analytics as Spark jobs.

Inventory listings land as JSON, become typed tables, are joined into one
privilege relation and a support-window report, and feed access reviews that
leave as CSV files per owner and come back through a file stream.
"""
