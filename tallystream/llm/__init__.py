"""Operators for preparing training data, beside the message metrics."""
