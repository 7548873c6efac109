"""Readers, sinks and the derivation of the domain tables."""
