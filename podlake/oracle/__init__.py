"""podlake.oracle"""
