"""Readers and parsers: raw access lines, JSON events, lookup replies, archives, JDBC."""
