"""Stages of name resolution, each a function from DataFrame to DataFrame."""
