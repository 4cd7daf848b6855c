"""Whole plans: curating documents, the reports, and exploration of a table."""
