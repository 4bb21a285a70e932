"""podlake.sources"""
