"""Operators: cleaning, marts, profiling, star schema and dashboard insights, all as DataFrame jobs."""
