"""Streams, delivery to drains, and the jobs that run for as long as there is input."""
