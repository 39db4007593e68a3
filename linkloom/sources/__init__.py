"""Readers. Every one takes an explicit schema."""
