"""millrace.sources"""
