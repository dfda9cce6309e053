"""Facts that arrive over time."""
