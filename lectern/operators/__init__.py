"""Operators on transcripts, turns, ledgers, captions and references, as DataFrames."""
