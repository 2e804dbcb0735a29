"""stratum.plans"""
