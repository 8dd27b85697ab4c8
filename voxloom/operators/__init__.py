"""DataFrame operators: joins, intervals, windows, reports, audio, models."""
