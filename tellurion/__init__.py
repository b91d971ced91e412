"""tellurion: telemetry analytics as functions from DataFrame to DataFrame."""
