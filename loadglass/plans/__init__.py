"""Reports: what the log says about traffic, latency, errors and load.

Every report takes a clean log or a rollup of one (see ``rollup``) and returns a
DataFrame. Reports over open-ended keys drop missing keys; reports over a fixed
grid come back with the whole grid.
"""
