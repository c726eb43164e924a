"""Readers and writers for labelled features, ratings and predictions."""
