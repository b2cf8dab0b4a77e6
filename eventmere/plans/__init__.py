"""Reports, panels and the list of runnable queries."""
