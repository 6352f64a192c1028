"""Sinks: table materialization, publish modes, comments, target naming."""
