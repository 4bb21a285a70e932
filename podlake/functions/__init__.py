"""podlake.functions"""
