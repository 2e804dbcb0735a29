"""stratum.functions"""
