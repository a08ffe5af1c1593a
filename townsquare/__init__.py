"""Townsquare: social-post analytics as Spark DataFrame jobs.

Sub-packages
------------
sources    readers, writers and load-time shaping (survey section 2A)
functions  column expressions and driver-side tail probabilities (2B, 2C)
operators  quality checks, roll-ups, statistics, topics and graphs (2D-2H)
streaming  the daily monitor as a stream (2K)
plans      alerts and whole-job composition (2K, 2L)
"""
