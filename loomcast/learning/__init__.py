"""Fitted state, feature selection, models per horizon and their records."""
