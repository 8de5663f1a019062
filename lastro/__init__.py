"""Receivables and draw-eligibility analytics on the Spark DataFrame API."""
