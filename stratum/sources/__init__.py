"""stratum.sources"""
