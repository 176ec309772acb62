"""The clean stage and the rollup over files that keep arriving.

This adds no new figures: the batch reports read the result. The reference data
model is batch only; this is a convenience for logs that are delivered in pieces.
"""
