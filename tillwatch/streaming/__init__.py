"""Structured Streaming: window-exact rules, the trailing scorer, sinks."""
