"""Table builders: the operators put together, one lazy plan per table."""
