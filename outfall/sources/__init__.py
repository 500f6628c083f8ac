"""Readers for envelopes and for the drain table. All schemas are explicit."""
