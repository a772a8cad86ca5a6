"""End-to-end flows: read, clean, score, report, forecast."""
