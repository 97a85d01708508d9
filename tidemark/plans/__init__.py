"""Dataset builders: holdings, mapping, stocks, reports, index bars, calendar, events."""
