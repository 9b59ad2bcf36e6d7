"""Whole jobs put together from operators: page extraction, star load, digests, fan-out."""
