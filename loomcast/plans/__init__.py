"""Panels over the given tables, registered queries with their SQL twins, and the forecast job."""
