"""Readers: statement files, sidecar files and dimension seeds."""
