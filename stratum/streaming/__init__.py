"""stratum.streaming"""
