"""Attendance as Structured Streaming; ``availableNow`` runs replace timed polling."""
