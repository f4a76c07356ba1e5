"""Interval, exposure and event analytics as DataFrame-to-DataFrame operators."""
