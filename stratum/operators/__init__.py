"""stratum.operators"""
