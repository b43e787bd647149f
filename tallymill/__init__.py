"""Batch analytics over payment-fraud transactions, as lazy DataFrame functions."""
