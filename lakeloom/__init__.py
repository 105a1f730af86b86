"""Lakehouse data engineering as plain PySpark DataFrame functions.

``sources``    readers, writers and table helpers
``functions``  column expressions
``operators``  DataFrame -> DataFrame building blocks
``plans``      end-to-end batch pipelines built from the operators
``streaming``  Structured Streaming pipelines
``catalogue``  every operator as a query, paired with the SQL that checks it
"""
