"""Rookery: analytics over short social posts, written on DataFrames and Structured Streaming."""
