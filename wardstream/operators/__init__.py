"""Batch operators, each ``DataFrame -> DataFrame``. The row-wise ones also run on a stream."""
