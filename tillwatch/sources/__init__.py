"""Readers and writers: messages, tables, the events adapter."""
