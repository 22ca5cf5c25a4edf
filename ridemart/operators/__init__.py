"""Relational operators: staging, dimensions, marts, quality, BI, forecasting, anomalies."""
