"""Declared schemas, file layers and message payloads."""
