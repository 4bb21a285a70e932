"""podlake.operators"""
