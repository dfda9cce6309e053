"""Rule sets and the phases they run in."""
