"""lustra: data cleansing, quality scoring, keyed history and PII masking on Spark.

Everything is a plain function from DataFrame to DataFrame or from Column to
Column, so the same code plans a batch job and a Structured Streaming job.
"""
