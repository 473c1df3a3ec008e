"""Delay analytics as Spark DataFrame programs.

Sub-packages
------------
``sources``    declared schemas, landing-zone readers, the code dimension, keyed tables
``functions``  column expressions: clamped minutes, calendar fields, weather fields, keys
``operators``  DataFrame -> DataFrame building blocks (joins, filters, caps, profiling, merging)
``plans``      end-to-end jobs: training set, serving features, models, scoring, reports
``streaming``  the same ingestion and enrichment steps as Structured Streaming queries
"""
