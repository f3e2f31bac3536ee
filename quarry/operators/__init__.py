"""Relational operators of the engine, DataFrame in, DataFrame out."""
