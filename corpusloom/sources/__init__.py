"""Readers, writers, packing, contracts and snapshot publishing."""
