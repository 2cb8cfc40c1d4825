"""Batch and Structured Streaming operators for text, invoices, message logs, trades and sensors."""
