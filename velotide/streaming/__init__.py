"""The hourly aggregate over a stream of trips."""
