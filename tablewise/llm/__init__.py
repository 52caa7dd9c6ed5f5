"""Operators of a training-data pipeline over the tables documents, pages,
benchmark and conversations.  Nothing else in the package imports this one."""
