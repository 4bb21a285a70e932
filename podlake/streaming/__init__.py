"""podlake.streaming"""
