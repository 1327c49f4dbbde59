"""Whole jobs put together from operators: the gold build, the views, the registered queries."""
