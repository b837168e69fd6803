"""The tables: silver, gold, dashboard cross-tabs and the run that writes them."""
