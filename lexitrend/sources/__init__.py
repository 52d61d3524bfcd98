"""Readers and writers."""

from . import comments, lists, sinks, testdata

__all__ = ["comments", "lists", "sinks", "testdata"]
