"""podlake.plans"""
